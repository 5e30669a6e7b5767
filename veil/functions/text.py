"""String helpers shared by the transcript and the detectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the Unicode sense; Spark's own ``trim`` strips blanks only.
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def flatten_newlines(text: Column) -> Column:
    """Newlines become blanks; carriage returns stay."""
    return F.translate(text, "\n", " ")


def trim_unicode(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_SPACE, "")


def between_tags(text: Column, tag: str, otherwise: Column) -> Column:
    """Text inside ``<tag>…</tag>``.

    With both tags in order: the trimmed text between the first start tag and
    the first end tag. With a start tag only (or an end tag that comes before
    it): the text without any start tag. Without a start tag: ``otherwise``.
    """
    start, end = f"<{tag}>", f"</{tag}>"
    at, to = F.instr(text, start), F.instr(text, end)
    inner = at + F.lit(len(start))
    return (
        F.when(at == 0, otherwise)
        .when(to >= inner, trim_unicode(F.substr(text, inner, to - inner)))
        .otherwise(F.replace(text, F.lit(start), F.lit("")))
    )


def wrapped(text: Column) -> Column:
    """Starts with ``[`` and ends with ``]``."""
    return F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
