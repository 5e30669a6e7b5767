"""Names and places from word lists.

A list may be as large as a customer table, so it is never broadcast by hand:
the candidates of the texts and the list meet in an equi-join and the
optimizer chooses the strategy from the sizes it measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run of capitalised words, each possibly with digits ("Customer#000000001").
WORD = r"\p{Lu}[\p{L}\p{N}#_'-]*"
ANY_WORD = r"[\p{L}\p{N}#_'-]+"
RUN, ANY_RUN = (rf"(?:^|[^\p{{L}}\p{{N}}#_'-])({w}(?: {w})*)" for w in (WORD, ANY_WORD))


def term_candidates(text: Column, longest: int, capitalised: bool = True) -> Column:
    """Distinct n-grams of up to ``longest`` words from runs of (capitalised) words."""
    runs = F.transform(
        F.regexp_extract_all(text, F.lit(RUN if capitalised else ANY_RUN), F.lit(1)),
        lambda r: F.split(r, " "),
    )
    grams = F.transform(
        runs,
        lambda w: F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(w)),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), F.size(w) - i + 1)),
                lambda n: F.array_join(F.slice(w, i, n), " "),
            ),
        )),
    )
    return F.array_distinct(F.flatten(grams))


def shape_of(terms: DataFrame) -> tuple[int, bool]:
    """Words of the longest term, and whether all words of all terms are capitalised."""
    longest, capitalised = terms.agg(
        F.max(F.size(F.split("term", " "))), F.bool_and(F.rlike("term", F.lit(rf"^{WORD}(?: {WORD})*$")))
    ).first()
    return longest or 1, capitalised is not False


def match_terms(turns: DataFrame, terms: DataFrame) -> DataFrame:
    """Terms of the list that occur in a session: ``(session_id, value, operator)``.

    ``terms`` has ``(term, operator)``. How long n-grams get, and whether words in
    lower case are candidates, follows from the list. Candidates are first reduced to one row
    per session and n-gram, with partial aggregation in the map tasks, so a word
    that fills a third of the texts reaches the join once per session. What skew
    remains is on the many side of an N:1 join, where adaptive execution splits
    the hot partition.
    """
    seen = turns.select(
        "session_id", F.explode(term_candidates(F.col("text"), *shape_of(terms))).alias("value")
    ).distinct()
    names = terms.select(F.col("term").alias("value"), "operator").distinct()
    return seen.join(names, "value").select("session_id", "value", "operator")
