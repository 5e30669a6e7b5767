"""Shapes of the data that flows through the library.

Everything here is plain Spark DDL, so that the same text serves
``spark.read.schema``, ``from_json`` and ``try_variant_get``.
"""

from __future__ import annotations

from dataclasses import dataclass

# One message as it arrives: the payload is a session log written as JSON.
ENVELOPE = (
    "seq BIGINT, published TIMESTAMP, subject STRING, "
    "headers MAP<STRING,STRING>, payload STRING"
)

# Header that names the session (fixed value).
SESSION_HEADER = "session_log_name"

# Shapes of a session log entry.
PARAMS = (
    "STRUCT<type STRING, properties MAP<STRING,STRUCT<type STRING, description STRING>>, "
    "required ARRAY<STRING>>"
)
FUNCTION = f"STRUCT<name STRING, description STRING, parameters {PARAMS}, arguments STRING>"
TOOL_CALL = f"STRUCT<index INT, function {FUNCTION}, id STRING, type STRING>"
CHAT_MESSAGE = (
    f"STRUCT<role STRING, content STRING, tool_calls ARRAY<{TOOL_CALL}>, turn INT>"
)
ARCHITECTURE = "STRUCT<architecture_type STRING>"
TOOL_REFS = "STRUCT<tool_calls ARRAY<STRUCT<turn INT, tool_calls ARRAY<STRING>>>>"
CHAT_GPT = (
    f"STRUCT<chat_gpt STRUCT<request STRUCT<chat_history ARRAY<{CHAT_MESSAGE}>, "
    f"functions ARRAY<{FUNCTION}>, model STRING, gpt_client STRING>, "
    f"response STRUCT<agent STRING, message {CHAT_MESSAGE}>, time DOUBLE>>"
)
TIME_SUMMARY = (
    "STRUCT<time_summary_s STRUCT<total_function_times STRUCT<timestamp DOUBLE, "
    "retrieve_state DOUBLE, get_rules DOUBLE, get_groups DOUBLE, get_devices DOUBLE, "
    "get_response DOUBLE>, total_request_time DOUBLE>>"
)

# Names of the five entry kinds.
KIND_ARCHITECTURE = "architecture"
KIND_TOOL_REFS = "tool_call_refs"
KIND_CHAT = "chat_message"
KIND_INTERACTION = "chat_interaction"
KIND_TIMING = "time_summary"

# A list of replacements for one session, in the order in which they apply.
PAIRS = "ARRAY<STRUCT<value STRING, replacement STRING>>"

OPERATOR_ROW = (
    "name STRING, type STRING, new_value STRING, masking_char STRING, "
    "chars_to_mask INT, from_end BOOLEAN, priority INT"
)


@dataclass(frozen=True)
class Operator:
    """One line of the operator table: how a kind of personal data is hidden."""

    name: str
    type: str  # 'replace' or 'mask'
    new_value: str | None = None
    masking_char: str | None = None
    chars_to_mask: int | None = None
    from_end: bool | None = None
    priority: int = 0

    def row(self) -> tuple:
        return (
            self.name, self.type, self.new_value, self.masking_char,
            self.chars_to_mask, self.from_end, self.priority,
        )


# The nineteen operators and their actions. The order is the
# order in which a value that fits several operators is assigned, first wins;
# DEFAULT comes last because every specific operator beats it.
_MASKED = {"PHONE_NUMBER": 6, "EMAIL_ADDRESS": 10, "CREDIT_CARD_NUMBER": 12}
_BY_PRIORITY = (
    "EMAIL_ADDRESS", "URL", "IBAN_CODE", "VIN", "CREDIT_CARD_NUMBER",
    "CREDIT_CARD_EXPIRY", "CREDIT_CARD_CVV", "PIN", "US_ITIN", "US_SSN",
    "CA_SIN", "US_BANK_ROUTING_NUMBER", "CA_HEALTH_NUMBER",
    "US_BANK_ACCOUNT_NUMBER", "SWIFT_CODE", "PHONE_NUMBER", "PERSON",
    "LOCATION", "DEFAULT",
)
OPERATORS: tuple[Operator, ...] = tuple(
    Operator(name, "mask", None, "*", _MASKED[name], True, rank)
    if name in _MASKED
    else Operator(
        name, "replace", "[REDACTED]" if name == "DEFAULT" else f"[{name}]", priority=rank
    )
    for rank, name in enumerate(_BY_PRIORITY, start=1)
)

# Masks of these two keep spaces, dashes and underscores (fixed values).
KEEP_SEPARATORS = ("PHONE_NUMBER", "CREDIT_CARD_NUMBER")
