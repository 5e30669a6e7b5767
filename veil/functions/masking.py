"""The two actions of the operator table: *replace* and *mask*."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veil.schema import KEEP_SEPARATORS, OPERATORS, Operator


def mask_chars(value: Column, count: int, char: str = "*", from_end: bool = True) -> Column:
    """Hide ``count`` characters at one end; shorter values are hidden whole."""
    length = F.char_length(value)
    hidden = F.repeat(F.lit(char), F.least(length, F.lit(count)).cast("int"))
    if from_end:
        return F.concat(F.left(value, length - F.lit(count)), hidden)
    return F.concat(hidden, F.substr(value, F.lit(count + 1)))


def mask_keep_separators(
    value: Column, count: int, char: str = "*", from_end: bool = True
) -> Column:
    """Like :func:`mask_chars`, but space, dash and underscore stay and do not count."""
    if not from_end:
        return F.reverse(mask_keep_separators(F.reverse(value), count, char))
    escaped = "\\" + char if char in "\\$" else char
    return F.regexp_replace(
        value, rf"[^ _-](?=(?:[ _-]*[^ _-]){{0,{count - 1}}}[ _-]*$)", escaped
    )


def act(operator: Operator, value: Column) -> Column:
    """What ``operator`` puts in the place of ``value``."""
    if operator.type != "mask":
        return F.lit(operator.new_value)
    hide = mask_keep_separators if operator.name in KEEP_SEPARATORS else mask_chars
    from_end = True if operator.from_end is None else operator.from_end
    return hide(value, operator.chars_to_mask or 0, operator.masking_char or "*", from_end)


def replacement(
    name: Column, value: Column, operators: Iterable[Operator] = OPERATORS
) -> Column:
    """Replacement by operator name; NULL for a name that is not in the table.

    Operators with the same action share a branch, so that the expression
    stays small for the usual table of many tags and few masks.
    """
    operators = tuple(operators)
    out: Column | None = None
    for op in operators:
        if op.type == "mask":
            branch = name == op.name
            out = F.when(branch, act(op, value)) if out is None else out.when(branch, act(op, value))
    tags = {op.name: op.new_value for op in operators if op.type != "mask"}
    lookup = F.lit(None).cast("string")
    if tags:
        pairs = [F.lit(x) for kv in tags.items() for x in kv]
        lookup = F.create_map(*pairs)[name]
    return lookup if out is None else out.otherwise(lookup)


def mask_by_operator(value: Column, type_: Column, new_value: Column, char: Column,
                     count: Column, from_end: Column, keep: Column) -> Column:
    """The same actions for an operator table that is itself a DataFrame.

    ``count`` and ``char`` are columns here, so the mask is built from the
    characters of the value instead of from a literal pattern.
    """
    chars = F.split(value, "")
    oriented = F.when(F.coalesce(from_end, F.lit(True)), F.reverse(chars)).otherwise(chars)
    is_sep = lambda c: c.isin(" ", "_", "-")
    walked = F.aggregate(
        oriented,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("seen")),
        lambda acc, c: F.struct(
            F.concat(
                acc["text"],
                F.when((keep & is_sep(c)) | (acc["seen"] >= count), c).otherwise(
                    F.coalesce(char, F.lit("*"))
                ),
            ).alias("text"),
            (acc["seen"] + F.when(keep & is_sep(c), 0).otherwise(1)).alias("seen"),
        ),
        lambda acc: acc["text"],
    )
    masked = F.when(F.coalesce(from_end, F.lit(True)), F.reverse(walked)).otherwise(walked)
    return F.when(type_ == "mask", masked).otherwise(new_value)
