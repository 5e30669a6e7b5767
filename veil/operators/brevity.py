"""Word-abbreviating compression of texts, inside the row.

Words that occur more than once become their first character and a running
number. Counts and places are computed on the sorted array of words of one text:
equal words are neighbours, so they need no shuffle and no exploded table of
words, which would be many times larger than the texts.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veil.functions.pin import pinned

# White space in the Unicode sense (fixed values).
_SPACE = "\t\n\x0b\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)
_EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def _plain(c: Column) -> Column:
    """Starts with an ASCII letter or digit."""
    return (
        ((c >= "a") & (c < "{")) | ((c >= "A") & (c < "[")) | ((c >= "0") & (c < ":"))
    )


def words(text: Column) -> Column:
    """Lower-case words in order, without punctuation at their ends.

    Splitting at one literal character is far quicker than at a pattern, so
    white space is made uniform first; and only words whose ends are not plain
    letters or digits are trimmed by a pattern.
    """
    parts = F.split(F.translate(text, _SPACE, " " * len(_SPACE)), " ")
    trimmed = F.transform(parts, lambda w: F.lower(
        F.when(_plain(w) & _plain(F.right(w, F.lit(1))), w)
        .otherwise(F.regexp_replace(w, _EDGES, ""))
    ))
    return F.filter(trimmed, lambda w: w != "")


def with_vocabulary(docs: DataFrame, text: str = "text", out: str = "vocabulary") -> DataFrame:
    """Add columns ``words`` and ``out``, the distinct words with count and places.

    ``out`` is ``array<struct<first int, word string, places array<int>>>`` ordered
    by first place (from 0).
    """
    sorted_, starts = f"_{out}_sorted", f"_{out}_starts"
    spoken = pinned(docs, words=words(F.col(text)))
    ordered = pinned(spoken, **{sorted_: F.expr(
        "sort_array(transform(words, (w, i) -> named_struct('word', w, 'place', i)))"
    )})
    # Where each run of equal words begins in the sorted array.
    runs = pinned(ordered, **{starts: F.expr(
        f"filter(transform({sorted_}, (x, i) -> "
        f"IF(i = 0 OR get({sorted_}, i - 1).word <> x.word, i, -1)), i -> i >= 0)"
    )})
    return pinned(runs, **{out: F.expr(
        f"sort_array(transform({starts}, (s, k) -> named_struct("
        f"'first', get({sorted_}, s).place, 'word', get({sorted_}, s).word, "
        f"'places', transform(slice({sorted_}, s + 1, "
        f"coalesce(get({starts}, k + 1), size({sorted_})) - s), x -> x.place))))"
    )}).drop(sorted_, starts)


def with_dictionary(docs: DataFrame, text: str = "text", out: str = "dictionary") -> DataFrame:
    """Add column ``out``: ``array<struct<abbr, word, places>>`` by first appearance.

    Words that occur once or start with an ASCII digit are not abbreviated.
    """
    listed, starts = f"_{out}_listed", f"_{out}_starts"
    # Sorted by initial, then by first place: the number of a word is its
    # distance from the first word with the same initial. There are few initials.
    known = pinned(with_vocabulary(docs, text), **{listed: F.expr(
        "sort_array(transform(filter(vocabulary, v -> size(v.places) > 1 AND "
        "NOT rlike(v.word, '^[0-9]')), v -> named_struct("
        "'initial', left(v.word, 1), 'first', v.first, 'word', v.word, 'places', v.places)))"
    )})
    known = pinned(known, **{starts: F.expr(
        f"map_from_entries(filter(transform({listed}, (v, i) -> IF(i = 0 OR "
        f"get({listed}, i - 1).initial <> v.initial, struct(v.initial, i), NULL)), s -> s IS NOT NULL))"
    )})
    return pinned(known, **{out: F.expr(
        f"transform(sort_array(transform({listed}, (v, i) -> named_struct("
        f"'first', v.first, 'word', v.word, 'places', v.places, 'abbr', concat(v.initial, "
        f"i + 1 - {starts}[v.initial])))), "
        "v -> named_struct('abbr', v.abbr, 'word', v.word, 'places', v.places))"
    )}).drop(listed, starts)


def _abbreviated(text: str) -> str:
    """A text of words at single blanks, with the words abbreviated that occur more than once."""
    spoken = text.split(" ")
    times = Counter(spoken)
    used: Counter[str] = Counter()
    # A counter keeps the order of first appearance, by which the words of an initial are numbered.
    for word, n in times.items():
        initial = word[:1]
        if n == 1 or "0" <= initial <= "9":
            times[word] = word
        else:
            used[initial] += 1
            times[word] = f"{initial}{used[initial]}"
    return " ".join(map(times.__getitem__, spoken))


def _brief(spoken: Column) -> Column:
    def abbreviated(texts: pd.Series) -> pd.Series:
        return texts.map(_abbreviated, na_action="ignore")

    return F.pandas_udf(abbreviated, T.StringType())(F.array_join(spoken, " "))


def brief(text: Column) -> Column:
    """The text with abbreviated words.

    Words are looked up by hash, text by text: sorting them as structs by word and again
    by place takes several times as long as finding them.
    """
    return _brief(words(text))


def with_brief_text(docs: DataFrame, text: str = "text", out: str = "brief") -> DataFrame:
    """Add columns ``dictionary`` and ``out``, the text with abbreviated words."""
    return with_dictionary(docs, text).withColumn(out, _brief(F.col("words")))
