"""Session logs: from payload text to typed entries, inside the row.

A log is parsed once into ``array<variant>``. Every entry is classified by
testing the types of its fields, because a cast would accept too much (``1.5``
or ``"7"`` for an integer). Then it is read into a fixed struct, which drops
unknown fields. A log stays one row throughout.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.pin import pinned
from veil.schema import (
    ARCHITECTURE,
    CHAT_GPT,
    CHAT_MESSAGE,
    KIND_ARCHITECTURE,
    KIND_CHAT,
    KIND_INTERACTION,
    KIND_TIMING,
    KIND_TOOL_REFS,
    TIME_SUMMARY,
    TOOL_REFS,
)

# Kind of entry -> shape. The only accepted architecture is a fixed value.
SHAPES = {
    KIND_ARCHITECTURE: ARCHITECTURE,
    KIND_CHAT: CHAT_MESSAGE,
    KIND_TOOL_REFS: TOOL_REFS,
    KIND_INTERACTION: CHAT_GPT,
    KIND_TIMING: TIME_SUMMARY,
}
ARCHITECTURE_TYPE = "Neocortex"

_names = count()


def _get(v: str, path: str, type_: str) -> str:
    return f"try_variant_get({v}, '{path}', '{type_}')"


def _type(v: str, path: str) -> str:
    """Type of the value at ``path``: NULL when absent, ``VOID`` for a JSON null."""
    return f"schema_of_variant({_get(v, path, 'variant')})"


def _is_string(v: str, path: str) -> str:
    return f"coalesce({_type(v, path)} = 'STRING', false)"


def _absent(v: str, path: str) -> str:
    return f"coalesce({_type(v, path)}, 'VOID') = 'VOID'"


def _maybe_string(v: str, path: str) -> str:
    return f"coalesce({_type(v, path)}, 'VOID') IN ('VOID', 'STRING')"


def _is_int(v: str, path: str) -> str:
    return f"(coalesce({_type(v, path)} = 'BIGINT', false) AND {_get(v, path, 'int')} IS NOT NULL)"


def _maybe_int(v: str, path: str) -> str:
    return f"({_absent(v, path)} OR {_is_int(v, path)})"


def _is_number(v: str, path: str) -> str:
    return f"coalesce(rlike({_type(v, path)}, '^(BIGINT|DECIMAL|DOUBLE|FLOAT)'), false)"


def _is_object(v: str, path: str) -> str:
    return f"coalesce({_type(v, path)} LIKE 'OBJECT<%', false)"


def _each(v: str, path: str, test) -> str:
    """An array whose elements all pass ``test``."""
    x = f"x{next(_names)}"
    return f"coalesce(forall({_get(v, path, 'array<variant>')}, {x} -> {test(x)}), false)"


def _each_value(v: str, path: str, test) -> str:
    """An object whose values all pass ``test``."""
    x = f"x{next(_names)}"
    values = f"map_values({_get(v, path, 'map<string,variant>')})"
    return f"coalesce(forall({values}, {x} -> {test(x)}), false)"


def _all(*tests: str) -> str:
    return "(" + " AND ".join(tests) + ")"


def _is_property(v: str) -> str:
    return _all(_is_string(v, "$.type"), _is_string(v, "$.description"))


def _is_parameters(v: str, path: str) -> str:
    strings = _each(v, f"{path}.required", lambda x: _is_string(x, "$"))
    properties = _each_value(v, f"{path}.properties", _is_property)
    return _all(
        _is_object(v, path), _maybe_string(v, f"{path}.type"),
        f"({_absent(v, f'{path}.properties')} OR {properties})",
        f"({_absent(v, f'{path}.required')} OR {strings})",
    )


def _is_function(v: str, path: str = "$") -> str:
    return _all(
        _is_string(v, f"{path}.name"), _maybe_string(v, f"{path}.description"),
        _maybe_string(v, f"{path}.arguments"),
        f"({_absent(v, f'{path}.parameters')} OR {_is_parameters(v, f'{path}.parameters')})",
    )


def _is_tool_call(v: str) -> str:
    return _all(
        _is_int(v, "$.index"), _is_function(v, "$.function"),
        _is_string(v, "$.id"), _is_string(v, "$.type"),
    )


def _is_chat(v: str, path: str = "$") -> str:
    calls = _each(v, f"{path}.tool_calls", _is_tool_call)
    return _all(
        _is_string(v, f"{path}.role"), _is_string(v, f"{path}.content"),
        _maybe_int(v, f"{path}.turn"),
        f"({_absent(v, f'{path}.tool_calls')} OR {calls})",
    )


def _is_tool_refs(v: str) -> str:
    return _each(v, "$.tool_calls", lambda x: _all(
        _maybe_int(x, "$.turn"), _each(x, "$.tool_calls", lambda y: _is_string(y, "$")),
    ))


def _is_interaction(v: str) -> str:
    request, response = "$.chat_gpt.request", "$.chat_gpt.response"
    return _all(
        _each(v, f"{request}.chat_history", _is_chat),
        _each(v, f"{request}.functions", _is_function),
        _is_string(v, f"{request}.model"), _is_string(v, f"{request}.gpt_client"),
        _is_object(v, response), _maybe_string(v, f"{response}.agent"),
        f"({_absent(v, f'{response}.message')} OR {_is_chat(v, f'{response}.message')})",
        _is_number(v, "$.chat_gpt.time"),
    )


def _is_timing(v: str) -> str:
    times = "$.time_summary_s.total_function_times"
    names = ("timestamp", "retrieve_state", "get_rules", "get_groups", "get_devices",
             "get_response")
    return _all(
        *(_is_number(v, f"{times}.{n}") for n in names),
        _is_number(v, "$.time_summary_s.total_request_time"),
    )


def kind_sql(v: str) -> str:
    """SQL text: kind of the entry ``v``, NULL when it has no known shape.

    A message with ``role`` and ``content`` counts as a message even if its
    ``tool_calls`` also fit the shape of tool-call references.
    """
    return (
        f"CASE WHEN {_get(v, '$.architecture_type', 'string')} = '{ARCHITECTURE_TYPE}' "
        f"AND {_is_string(v, '$.architecture_type')} THEN '{KIND_ARCHITECTURE}' "
        f"WHEN {_is_chat(v)} THEN '{KIND_CHAT}' "
        f"WHEN {_is_tool_refs(v)} THEN '{KIND_TOOL_REFS}' "
        f"WHEN {_is_interaction(v)} THEN '{KIND_INTERACTION}' "
        f"WHEN {_is_timing(v)} THEN '{KIND_TIMING}' END"
    )


def ambiguous_sql(v: str) -> str:
    """SQL text: the entry fits both the message and the references shape."""
    return f"({_is_chat(v)} AND {_is_tool_refs(v)})"


def entries(payload: Column) -> Column:
    """The log as ``array<variant>``; NULL for anything but one JSON array.

    The parser ignores text behind the first value, so the payload is parsed
    as the only element of an array, which makes such text an error.
    """
    whole = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]"))), "$", "array<variant>"
    )
    return F.when(
        F.size(whole) == 1, F.try_variant_get(F.get(whole, F.lit(0)), "$", "array<variant>")
    )


def with_log(envelopes: DataFrame, payload: str = "payload", out: str = "log") -> DataFrame:
    """Add the typed log: an array of structs, one per entry, in entry order.

    Each struct has ``kind`` and one nullable field per shape. The column is
    NULL when the payload is no log or when any entry has no known shape.
    """
    raw, kinds = f"_{out}_raw", f"_{out}_kinds"
    fields = ", ".join(
        f"'{kind}', CASE WHEN k = '{kind}' THEN {_get('e', '$', shape)} END"
        for kind, shape in SHAPES.items()
    )
    typed = f"zip_with({raw}, {kinds}, (e, k) -> named_struct('kind', k, {fields}))"
    split = pinned(envelopes, **{raw: entries(F.col(payload))})
    known = pinned(split, **{kinds: F.expr(f"transform({raw}, e -> {kind_sql('e')})")})
    whole = F.expr(f"CASE WHEN forall({kinds}, k -> k IS NOT NULL) THEN {typed} END")
    return pinned(known, **{out: whole}).drop(raw, kinds)


def entry_rows(envelopes: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """One row per entry of every parseable log: keys, ``pos``, ``kind``, ``ambiguous_kind``."""
    rows = envelopes.select(
        *keys, F.posexplode_outer(entries(F.col(payload))).alias("pos", "entry")
    ).where(F.col("pos").isNotNull())
    return rows.select(
        *keys, "pos", "entry", F.expr(kind_sql("entry")).alias("kind"),
        F.expr(ambiguous_sql("entry")).alias("ambiguous_kind"),
    )


def log_json(log: Column) -> Column:
    """Typed log as JSON text: known fields only, absent optionals left out."""
    return F.concat(
        F.lit("["), F.array_join(F.transform(log, entry_json), ","), F.lit("]")
    )


def entry_json(entry: Column) -> Column:
    return F.coalesce(*[F.to_json(entry[kind]) for kind in SHAPES])
