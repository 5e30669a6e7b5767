"""Rule detection of the nineteen operators.

The core is an expression over one text: every rule looks at the text once,
inside the same projection, and the result is an array of candidates. Nothing
is exploded or shuffled to detect; a row of any length stays a row.

Two physical forms are built on it:

* *row form* (:func:`with_found`): the candidates of one text, or of a whole
  session log held in one row, resolved inside the row. No shuffle.
* *long form* (:func:`detect`): one row per session and value. The only shuffle
  is the aggregation on ``(session_id, value)``, which combines on the map side
  and has no hot key even when one session holds most of the rows.

The expressions are assembled as SQL text, which is far quicker to build than
the same tree made of column objects.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions import masking
from veil.functions.pin import pinned
from veil.functions.checksums import digits
from veil.functions.text import literal
from veil.operators.rules import (
    ALLOWED_SHAPES,
    ALLOWED_WORDS,
    CUED,
    RULES,
    SHARED,
    SPACED_RULES,
    Rule,
)
from veil.schema import OPERATORS, Operator

_RANGE = re.compile("([0-9A-Za-z])-([0-9A-Za-z])")


def spelled_classes(pattern: str) -> str:
    """The same pattern with ranges of letters and digits inside ``[…]`` written out.

    The regular-expression engine looks a listed character up in a bit set, but asks one
    range after the other; the patterns of the rules spend most of their time there.
    """
    def spelled(m: re.Match) -> str:
        return "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1)))

    # A class begins at an unescaped bracket; the rules have no class inside a class.
    return re.sub(r"\\.|\[(?:\\.|[^\]\\])*\]",
                  lambda m: _RANGE.sub(spelled, m[0]) if m[0].startswith("[") else m[0], pattern)


def pattern_sql(pattern: str) -> str:
    """SQL text of a pattern, in the form that is quickest to match."""
    return literal(spelled_classes(pattern))


_NONE = "cast(array() AS array<string>)"

# Operators whose rules rest on capitals or cue words and can hit a device name.
CHECKED_AGAINST_ALLOWED = ("PERSON", "LOCATION", "DEFAULT")


@dataclass(frozen=True)
class Scan:
    """Names of the columns that hold a text prepared for the rules."""

    # Only the lines that contain a digit or a cue. No rule matches across a line
    # break, so all rules find the same values here as in the whole text, and most
    # text has few such lines.
    text: str
    lowered: str
    # Only the lines that contain a digit, for the rules for numbers.
    numeric: str
    numeric_lowered: str
    # How many digits these lines have.
    digits: str
    # Pattern -> column with its hits, for patterns that several rules use.
    shared: dict[str, str]


def lines_with(text: str, pattern: str) -> Column:
    """The lines of a text in which the pattern is found, an empty text for none."""
    found = pattern_sql(pattern)
    lines = f"filter(split({text}, '\\n'), line -> rlike(line, {found}))"
    return F.expr(
        f"CASE WHEN NOT rlike({text}, {found}) THEN '' WHEN NOT contains({text}, '\\n') "
        f"THEN {text} ELSE array_join({lines}, '\\n') END"
    )


def scanned(df: DataFrame, text: str = "text") -> tuple[DataFrame, Scan]:
    """Add the prepared parts as columns, so that all rules share them."""
    scan = Scan(
        *(f"_{text}_{x}" for x in ("cued", "lower", "num", "num_lower", "digits")),
        {pattern: f"_{text}_{name}" for name, pattern, *_ in SHARED},
    )
    out = df.withColumn(scan.text, lines_with(text, CUED)).withColumns({
        scan.lowered: F.expr(f"lower({scan.text})"),
        scan.numeric: lines_with(scan.text, "[0-9]"),
    })
    out = out.withColumns({
        scan.numeric_lowered: F.expr(f"lower({scan.numeric})"),
        scan.digits: F.expr(f"char_length({digits(scan.numeric)})"),
    })
    return out.withColumns({
        scan.shared[pattern]: F.expr(
            f"CASE WHEN {scan.digits} >= {fewest} AND rlike({scan.numeric}, {pattern_sql(hint)}) THEN "
            f"regexp_extract_all({scan.numeric}, {pattern_sql(pattern)}, 1) ELSE {_NONE} END"
        )
        for _, pattern, fewest, hint in SHARED
    }), scan


def rule_values(scan: Scan, rule: Rule) -> str:
    """SQL text: values one rule finds in a text, an empty array for none.

    The pattern runs only where the text has enough digits and one of the
    rule's literals.
    """
    text = scan.numeric if rule.digits else scan.text
    lowered = scan.numeric_lowered if rule.digits else scan.lowered
    hits = scan.shared.get(
        rule.pattern, f"regexp_extract_all({text}, {pattern_sql(rule.pattern)}, 1)"
    )
    if rule.check is not None:
        hits = f"filter({hits}, v -> {rule.check('v')})"
    tests = [
        f"contains({lowered if n == n.lower() else text}, {literal(n)})" for n in rule.needles
    ]
    gates = [f"{scan.digits} >= {rule.digits}"] if rule.digits else []
    gates += [f"({' OR '.join(tests)})"] if tests else []
    gates += [f"rlike({text}, {pattern_sql(rule.hint)})"] if rule.hint else []
    return f"CASE WHEN {' AND '.join(gates)} THEN {hits} ELSE {_NONE} END"


def operator_values(scan: Scan, operator: str, rules: Iterable[Rule] = RULES) -> str:
    """SQL text: values of one operator in a text, repeated if several rules find them."""
    parts = [rule_values(scan, r) for r in rules if r.operator == operator]
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def allowed_sql(v: str) -> str:
    """SQL text: device names, units, languages, times and measurements stay."""
    words = ", ".join(literal(w) for w in ALLOWED_WORDS)
    return f"(lower({v}) IN ({words}) OR rlike({v}, {literal(ALLOWED_SHAPES)}))"


def is_allowed(column: str) -> Column:
    """Whether the value in ``column`` is never masked."""
    return F.expr(allowed_sql(column))


def candidates(
    scan: Scan, operators: Iterable[Operator] = OPERATORS, spaced: bool = True
) -> Column:
    """All candidates of a text: ``array<struct<value, priority, operator>>``.

    Rules of operators that are not in ``operators`` are not run.
    """
    rules = RULES + (SPACED_RULES if spaced else ())
    parts = []
    for op in operators:
        if not any(r.operator == op.name for r in rules):
            continue
        values = operator_values(scan, op.name, rules)
        if op.name in CHECKED_AGAINST_ALLOWED:
            values = f"filter({values}, v -> NOT {allowed_sql('v')})"
        parts.append(
            f"transform({values}, v -> named_struct('value', v, "
            f"'priority', {op.priority}, 'operator', {literal(op.name)}))"
        )
    return F.expr(f"concat({', '.join(parts)})")


def resolve(hits: str, operators: Iterable[Operator] = OPERATORS) -> Column:
    """One replacement per value: the best priority wins, equal pairs are dropped.

    ``hits`` names a column with candidates sorted by value and priority; the
    first of each run of equal values is kept. Result:
    ``array<struct<value, replacement, operator>>``.
    """
    firsts = F.expr(
        f"filter({hits}, (x, i) -> i = 0 OR get({hits}, i - 1).value <> x.value)"
    )
    chosen = F.transform(
        firsts,
        lambda h: F.struct(
            h["value"].alias("value"),
            masking.replacement(h["operator"], h["value"], operators).alias("replacement"),
            h["operator"].alias("operator"),
        ),
    )
    return F.filter(
        chosen, lambda p: p["replacement"].isNotNull() & (p["replacement"] != p["value"])
    )


def with_found(
    df: DataFrame, text: str = "text", out: str = "found",
    operators: Iterable[Operator] = OPERATORS, spaced: bool = True,
) -> DataFrame:
    """Row form: add the resolved pairs of column ``text`` as array column ``out``."""
    operators = tuple(operators)
    hits = f"_{out}_hits"
    rows, scan = scanned(df, text)
    sorted_hits = F.sort_array(F.coalesce(candidates(scan, operators, spaced), F.array()))
    found = pinned(rows, **{hits: sorted_hits})
    return pinned(found, **{out: resolve(hits, operators)}).select(*df.columns, out)


def detect(
    turns: DataFrame, operators: Iterable[Operator] = OPERATORS, spaced: bool = True,
    extra: DataFrame | None = None,
) -> DataFrame:
    """Long form: ``(session_id, value, operator, replacement)``, one row per value.

    ``extra`` holds further candidates ``(session_id, value, operator)``, for
    example from :func:`veil.operators.gazetteer.match_terms`.
    """
    operators = tuple(operators)
    texts, scan = scanned(turns)
    rows = texts.select(
        "session_id", F.explode(candidates(scan, operators, spaced)).alias("h")
    ).selectExpr("session_id", "h.value AS value", "h.priority AS priority")
    if extra is not None:
        ranks = F.create_map(*[F.lit(x) for op in operators for x in (op.name, op.priority)])
        more = extra.select(
            "session_id", "value", ranks[F.col("operator")].alias("priority")
        ).where(F.col("priority").isNotNull() & ~is_allowed("value"))
        rows = rows.unionByName(more)
    return best_operator(rows, operators)


def best_operator(rows: DataFrame, operators: Iterable[Operator] = OPERATORS) -> DataFrame:
    """Settle values found by several operators in one session.

    The priority alone is aggregated: an integer buffer keeps this a hash
    aggregation with partial results on the map side.
    """
    operators = tuple(operators)
    names = F.create_map(*[F.lit(x) for op in operators for x in (op.priority, op.name)])
    return (
        rows.groupBy("session_id", "value")
        .agg(names[F.min("priority")].alias("operator"))
        .select(
            "session_id", "value", "operator",
            masking.replacement(F.col("operator"), F.col("value"), operators).alias("replacement"),
        )
        .where(F.col("replacement").isNotNull() & (F.col("value") != F.col("replacement")))
    )


def detect_operator(turns: DataFrame, operator: str) -> DataFrame:
    """Values of a single operator per text, before priorities are settled."""
    texts, scan = scanned(turns)
    return texts.selectExpr(
        "session_id", "turn", f"explode(array_distinct({operator_values(scan, operator)})) AS value"
    )


def detect_spaced_digits(turns: DataFrame) -> DataFrame:
    """Numbers whose digits were written apart, with the operator they belong to."""
    texts, scan = scanned(turns)
    parts = [
        f"transform(array_distinct({operator_values(scan, name, SPACED_RULES)}), "
        f"v -> named_struct('operator', {literal(name)}, 'value', v))"
        for name in dict.fromkeys(r.operator for r in SPACED_RULES)
    ]
    return texts.selectExpr(
        "session_id", "turn", f"inline(concat({', '.join(parts)}))"
    )


def apply_allow_list(found: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Remove values that must stay, by fixed words and by an optional word list.

    The list is joined by equality on the lower-cased value; whether it is
    small enough to broadcast is left to the optimizer, which knows its size.
    """
    kept = found.where(~is_allowed("value"))
    if allow is None:
        return kept
    words = allow.select(F.lower("value").alias("_word")).distinct()
    return kept.withColumn("_word", F.lower("value")).join(words, "_word", "left_anti").drop("_word")
