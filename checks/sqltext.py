"""Pieces of DuckDB SQL shared by the oracles, written independently of the library."""

from __future__ import annotations

from veil.operators import rules as R
from veil.schema import OPERATORS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '', 'g')"


def luhn(v: str) -> str:
    """Every second digit from the right is doubled and its digits are summed."""
    d = digits(v)
    digit = f"CAST(substr({d}, len({d}) - i + 1, 1) AS INT)"
    return (
        f"({d} <> '' AND coalesce(list_sum(list_transform(range(1, len({d}) + 1), lambda i: "
        f"CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 "
        f"ELSE 2 * {digit} END)), 1) % 10 = 0)"
    )


def aba(v: str) -> str:
    return (
        f"(len({v}) = 9 AND list_sum(list_transform(range(1, 10), lambda i: "
        f"[3, 7, 1][CAST((i - 1) % 3 + 1 AS INT)] * CAST('0' || substr({v}, i, 1) AS INT))) % 10 = 0)"
    )


def iban(v: str) -> str:
    bare = f"replace({v}, ' ', '')"
    codes = (
        f"list_transform(string_split(concat(substr({bare}, 5), substr({bare}, 1, 4)), ''), "
        "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"
    )
    return (
        f"(len({bare}) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, {codes}), "
        "lambda a, x: CASE WHEN x < 10 THEN (a * 10 + x) % 97 ELSE (a * 100 + x) % 97 END) = 1)"
    )


def like(v: str, pattern: str) -> str:
    return f"regexp_matches({v}, {q(pattern)})"


def itin(v: str) -> str:
    return like(digits(v), "^9[0-9]{2}[78][0-9]{5}$")


def count(v: str) -> str:
    return f"len({digits(v)})"


# Operator -> list of (pattern, condition on v).
RULES: dict[str, list[tuple[str, str]]] = {
    "EMAIL_ADDRESS": [(R.EMAIL, "true"), (R.EMAIL_LONG, "strpos(v, '@') > 65")],
    "URL": [(R.URL, "true")],
    "IBAN_CODE": [(R.IBAN_PLAIN, iban("v")), (R.IBAN_GROUPED, iban("v"))],
    "VIN": [(R.VIN, f"len(v) = 17 AND {like('v', '[A-Z]')} AND {like('v', '[0-9]')}")],
    "CREDIT_CARD_NUMBER": [
        (R.CARD, f"{count('v')} BETWEEN 13 AND 19 AND {luhn('v')}"),
        (R.CARD_CUED, f"{count('v')} BETWEEN 8 AND 19")],
    "CREDIT_CARD_EXPIRY": [(R.EXPIRY, like("v", "[/-](?:[0-9]{2}|[0-9]{4})$"))],
    "CREDIT_CARD_CVV": [(R.CVV, "len(v) IN (3, 4)")],
    "PIN": [(R.PIN, "len(v) = 4")],
    "US_ITIN": [(R.ITIN, itin("v"))],
    "US_SSN": [(R.SSN, f"len(v) = 11 AND NOT {itin('v')}"),
               (R.SSN_CUED, f"{count('v')} = 9 AND NOT {itin('v')}")],
    "CA_SIN": [(R.SIN, f"{count('v')} = 9 AND {luhn('v')}")],
    "US_BANK_ROUTING_NUMBER": [(R.ROUTING, aba("v"))],
    "CA_HEALTH_NUMBER": [(R.HEALTH, f"{count('v')} = 10")],
    "US_BANK_ACCOUNT_NUMBER": [(R.ACCOUNT, f"{count('v')} BETWEEN 10 AND 12")],
    "SWIFT_CODE": [(R.SWIFT, like("v", "^[A-Z]{6}[A-Z0-9]{2}(?:[A-Z0-9]{3})?$"))],
    "PHONE_NUMBER": [
        (R.PHONE, f"{count('v')} BETWEEN 7 AND 15 AND {like('v', '[ .-][0-9]{4}$')}"),
        (R.PHONE_INTL, f"{count('v')} BETWEEN 7 AND 15"),
        (R.PHONE_CUED, f"{count('v')} BETWEEN 7 AND 15")],
    "PERSON": [(R.PERSON, "true"), (R.PERSON_I_AM, "true")],
    "LOCATION": [(R.STREET, "true"), (R.PLACE, "true"),
                 (R.ZIP, like("v", "^[0-9]{5}(?:-[0-9]{4})?$"))],
    "DEFAULT": [
        (R.IPV4, "list_bool_and(list_transform(string_split(v, '.'), lambda o: "
                 "len(o) <= 3 AND CAST(o AS BIGINT) <= 255 AND (len(o) = 1 OR o[1] <> '0'))) "
                 "AND len(string_split(v, '.')) = 4"),
        (R.SECRET, "true"),
        (R.CARD, f"{count('v')} BETWEEN 13 AND 19 AND NOT {luhn('v')}"),
        (R.ID_NUMBER, like("v", "[0-9]")),
        (R.USER_NAME, "true")],
}
_APART = like("v", "^[0-9](?:[ ._-][0-9])+$")
SPACED: dict[str, str] = {
    "CREDIT_CARD_NUMBER": f"{_APART} AND {count('v')} BETWEEN 13 AND 19 AND {luhn('v')}",
    "US_ITIN": f"{_APART} AND {itin('v')}",
    "US_SSN": f"{_APART} AND {count('v')} = 9 AND NOT {itin('v')}",
    "PHONE_NUMBER": f"{_APART} AND {count('v')} IN (7, 8, 10, 11, 12, 13, 14, 15)",
    "DEFAULT": f"{_APART} AND ({count('v')} > 19 OR {count('v')} > 15 AND NOT {luhn('v')})",
}
PRIORITY = {op.name: op.priority for op in OPERATORS}


def hits(pattern: str, condition: str, source: str = "corpus", keys: str = "session_id, turn") -> str:
    return (
        f"SELECT DISTINCT {keys}, v AS value FROM (SELECT {keys}, "
        f"unnest(regexp_extract_all(text, {q(pattern)}, 1)) AS v FROM {source}) WHERE {condition}"
    )


def operator_hits(name: str, source: str = "corpus", keys: str = "session_id, turn") -> str:
    return " UNION ".join(hits(p, c, source, keys) for p, c in RULES[name])


def spaced_hits(name: str, source: str = "corpus", keys: str = "session_id, turn") -> str:
    return hits(R.SPACED, SPACED[name], source, keys)


def allowed(v: str) -> str:
    words = ", ".join(q(w) for w in R.ALLOWED_WORDS)
    return f"(lower({v}) IN ({words}) OR {like(v, R.ALLOWED_SHAPES)})"


def candidates(source: str = "corpus", keys: str = "session_id") -> str:
    """CTE body: keys, value, priority of every rule, allow list applied."""
    parts = []
    for name in RULES:
        keep = f"NOT {allowed('value')}" if name in ("PERSON", "LOCATION", "DEFAULT") else "true"
        parts.append(f"SELECT {keys}, value, {PRIORITY[name]} AS priority "
                     f"FROM ({operator_hits(name, source, keys)}) WHERE {keep}")
    for name in SPACED:
        parts.append(f"SELECT {keys}, value, {PRIORITY[name]} FROM ({spaced_hits(name, source, keys)})")
    return "\n  UNION ALL ".join(parts)


NAMES = "[" + ", ".join(q(op.name) for op in sorted(OPERATORS, key=lambda o: o.priority)) + "]"


def mask_end(v: str, k: int) -> str:
    return f"concat(substr({v}, 1, greatest(len({v}) - {k}, 0)), repeat('*', least(len({v}), {k})))"


def mask_sep(v: str, k: int | str) -> str:
    rest = f"len(regexp_replace(substr({v}, i), '[ _-]', '', 'g'))"
    return (
        f"array_to_string(list_transform(range(1, len({v}) + 1), lambda i: CASE WHEN "
        f"substr({v}, i, 1) IN (' ', '_', '-') OR {rest} > {k} THEN substr({v}, i, 1) "
        "ELSE '*' END), '')"
    )


def replacement(operator: str, v: str) -> str:
    return (
        f"CASE {operator} WHEN 'EMAIL_ADDRESS' THEN {mask_end(v, 10)} "
        f"WHEN 'PHONE_NUMBER' THEN {mask_sep(v, 6)} "
        f"WHEN 'CREDIT_CARD_NUMBER' THEN {mask_sep(v, 12)} "
        f"WHEN 'DEFAULT' THEN '[REDACTED]' ELSE concat('[', {operator}, ']') END"
    )


def settled(candidates_cte: str, keys: str = "session_id") -> str:
    """CTE body: keys, value, operator, replacement."""
    return (
        f"SELECT {keys}, value, operator, replacement FROM (SELECT *, "
        f"{replacement('operator', 'value')} AS replacement FROM (SELECT {keys}, value, "
        f"{NAMES}[min(priority)] AS operator FROM {candidates_cte} GROUP BY {keys}, value)) "
        "WHERE value <> replacement"
    )


def found(source: str = "corpus", keys: str = "session_id") -> str:
    """Two CTEs, ``cands`` and ``found``, over a texts CTE."""
    return f"cands AS ({candidates(source, keys)}),\nfound AS ({settled('cands', keys)})"


def ordered_pairs(source: str = "found", keys: str = "session_id") -> str:
    """CTE body: keys and the list ``p`` of {v, r}, longest value first."""
    return (
        f"SELECT {keys}, list({{'v': value, 'r': replacement}} ORDER BY len(value) DESC, value) AS p "
        f"FROM {source} WHERE value <> '' AND value <> replacement GROUP BY {keys}"
    )


def applied(text: str, p: str = "p") -> str:
    """``text`` after the pairs that occur in it."""
    present = f"list_filter({p}, lambda x: contains({text}, x.v))"
    return (
        f"CASE WHEN {p} IS NULL OR {text} IS NULL THEN {text} ELSE list_reduce(list_prepend("
        f"{{'v': {text}, 'r': ''}}, {present}), "
        "lambda a, x: {'v': replace(a.v, x.v, x.r), 'r': ''}).v END"
    )
