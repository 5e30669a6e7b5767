"""Strings inside JSON text: read and rewritten token by token, as column expressions.

An escaped backslash and an escaped quote are first marked by control characters, which
JSON text cannot hold as themselves; what then stands between quotes is a string, every
second part of the text. A string is decoded by the JSON reader, so every spelling of a
character counts as that character; it is written back only if it has changed. A
string that is JSON text itself is gone into, ``DEPTH`` times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: JSON text inside strings of JSON text is followed so many times.
DEPTH = 3
_BACKSLASH, _QUOTE = "\u0001", "\u0002"
# What only the reader can tell the meaning of; a quote ends a string, so none is inside.
_SPELLED = r'[\x00-\x1f\\"]'
# Places beside a number in the text between strings.
_AROUND_NUMBERS = r"(?<=[\[,:\s])|(?=[\],}\s])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_json(text: Column) -> Column:
    """Whether the whole text is JSON; the reader alone would pass over what follows a value."""
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    # In a list a number ends at a comma, by itself it does not.
    alone = F.when(text.rlike(r"^\s*[-0-9]"), F.try_parse_json(text).isNotNull()).otherwise(F.lit(True))
    return (F.coalesce(F.size(whole), F.lit(0)) > 0) & alone


def encoded(text: Column) -> Column:
    """A text as it stands inside a JSON string."""
    return F.regexp_replace(F.to_json(F.array(text)), r'^\["|"\]$', "")


def marked(text: Column) -> Column:
    """JSON text with its escaped backslashes and quotes marked, so that a quote ends a string."""
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))


def unmarked(text: Column) -> Column:
    """Undo :func:`marked`."""
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def decoded(part: Column) -> Column:
    """What a string says; NULL where the reader does not take it.

    A string without marks, backslashes and control characters says what is written.
    """
    read = F.get(F.from_json(F.concat(F.lit('["'), unmarked(part), F.lit('"]')), "array<string>"), F.lit(0))
    return F.when(F.rlike(part, F.lit(_SPELLED)), read).otherwise(part)


def _is_nested(text: Column) -> Column:
    return text.rlike(r'^\s*[\[{"]') & is_json(text)


def read_parts(text: Column) -> Column:
    """JSON text cut at its quotes: ``raw``, marked, and ``said``, what a string says, for every second part.

    ``said`` is NULL where the reader does not take the string. To be bound by :func:`let`,
    so that a text is read once however often it is looked at.
    """
    return F.transform(F.split(marked(text), '"'), lambda p, i: F.struct(
        p.alias("raw"), F.when(i % 2 == 1, decoded(p)).alias("said")))


def rewritten(text: Column, change: Callable[[Column], Column], depth: int = DEPTH) -> Column:
    """JSON text with ``change`` applied to what its strings say and to its numbers.

    Strings and numbers that do not change stay as they are written; a number that
    changes becomes a string. Beyond ``depth`` a string of JSON is plain text.
    """
    return let(read_parts(text), lambda parts: rewritten_parts(parts, change, depth))


def rewritten_parts(parts: Column, change: Callable[[Column], Column], depth: int = DEPTH) -> Column:
    """The same for a text that is cut already, by :func:`read_parts`."""
    def inside(part: Column) -> Column:
        raw, d = part["raw"], part["said"]

        plain = change(d)
        new = F.when(_is_nested(d), rewritten(d, change, depth - 1)).otherwise(plain) if depth else plain
        written = let(new, lambda n: F.when(n.eqNullSafe(d) | n.isNull(), raw).otherwise(encoded(n)))
        return F.when(d.isNull(), raw).otherwise(written)

    def number(piece: Column) -> Column:
        new = let(change(piece), lambda n: F.when(n == piece, piece).otherwise(F.concat(F.lit('"'), encoded(n), F.lit('"'))))
        return F.when(piece.rlike("^-?[0-9]"), new).otherwise(piece)

    def between(raw: Column) -> Column:
        return F.when(raw.rlike("[0-9]"), F.array_join(F.transform(F.split(raw, _AROUND_NUMBERS), number), "")).otherwise(raw)

    done = F.transform(parts, lambda p, i: F.when(i % 2 == 1, inside(p)).otherwise(between(p["raw"])))
    return unmarked(F.array_join(done, '"'))


def spelled_out(text: Column, depth: int = DEPTH) -> Column:
    """JSON text with its strings as what they say, to be read and not to be parsed."""
    return let(read_parts(text), lambda parts: spelled_parts(text, parts, depth))


def spelled_parts(text: Column, parts: Column, depth: int = DEPTH) -> Column:
    """The same for a text that is cut already, by :func:`read_parts`."""
    def inside(part: Column) -> Column:
        d = part["said"]
        # Without a backslash the strings inside say what is written.
        nested = F.contains(d, F.lit("\\")) & _is_nested(d)
        return F.coalesce(F.when(nested, spelled_out(d, depth - 1)).otherwise(d) if depth else d, part["raw"])

    out = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, inside(p)).otherwise(p["raw"])), '"')
    # Without a backslash strings say what is written; control characters are for the reader to tell.
    return F.when(F.rlike(text, F.lit(r"[\x00-\x1f\\]")), out).otherwise(text)
