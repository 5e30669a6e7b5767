"""Spelling variants: words one edit apart, and the form each of them goes back to.

*Words* are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased; words of at least
``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times are compared.

*Asymmetric q-chunks.* The longer word x (of two equally long ones, either) is cut into two
disjoint chunks; the other word y gives its positional grams of the same sizes. One edit
lies in one chunk only, so the other is a gram of y, at its own place before the edit and
shifted by the difference of the lengths, nought or one, behind it. Grams at other places
belong to words with more edits and are not sent. The chunk that holds the edit is cut in
two in the same way, until two code points are left: what is joined on is x without two
neighbouring places, and y without the places that stand against them. Words that share
such a key differ within two places, so a key has at most 8,190 words whatever the text
(90 letters are left after lower-casing: 90 * 90 + 90). Pairs are verified by their edit distance. A pair
that fits several keys, as in runs of one letter, is taken at its first difference only.

*Forms.* A word's form is its near word with the largest count (ties: least in code-point
order) if that is at least ``RATIO`` times its own. Roots follow the forms by pointer
doubling: counts at least double at each step, so there are few rounds.

Results: null texts have no words; a null id is written as nothing where ids enter a hash.
Repeated rows count again. An empty table gives an empty table. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import delete, shared_folder

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: One occurrence in so many is altered by :func:`garbled`.
GARBLED = 97
#: Code points that a key leaves out.
GAP = 2


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (as text) and ``word`` of every run of letters."""
    found = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(LETTERS), F.lit(0))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("word"))


def garbled(doc_id: Column, word: Column) -> Column:
    """The word, without one code point where 97 divides the CRC-32 of ``doc_id:word``."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), word))
    place = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))
    return F.when(h % GARBLED == 0, cut).otherwise(word)


def frequent(words: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    long = words.where(F.length("word") >= LEAST_LENGTH)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keys(words: DataFrame, name: str, longer: Column, size: Column) -> DataFrame:
    """One row per word, length of x and gap: ``size`` of x, ``gap``, ``key`` and the word's own length.

    The gaps of a word of length ``size`` come from halving it until ``GAP`` places are left:
    that is the places from 0, 2, 4, … on, two each, or one at the end.
    """
    spread = words.select(
        F.col("word").alias(name), F.col("n").alias(f"{name}_n"), longer.alias("shorter"), size.alias("size"))
    gaps = F.sequence(F.lit(0), F.col("size") - 1, F.lit(GAP))
    rows = spread.select("*", F.explode(gaps).alias("gap"))
    behind = F.greatest(F.col("size") - F.col("gap") - GAP, F.lit(0))  # places of x behind the gap
    own = F.length(name)
    key = F.concat(F.substring(name, F.lit(1), F.col("gap")), F.lit(" "), F.substring(name, own - behind + 1, behind))
    return rows.select(name, f"{name}_n", "size", "shorter", "gap", key.alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of words one edit apart once: ``x``, ``x_n``, ``y``, ``y_n``."""
    size = F.length("word")
    chunks = _keys(words, "x", F.explode(F.array(F.lit(0), F.lit(1))), size)
    grams = _keys(words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("shift")), "y", F.col("shift"), size + F.col("shift"))
    met = chunks.join(grams, ["size", "shorter", "gap", "key"])
    first = F.col("gap") + GAP
    differs = F.substring("x", F.lit(1), first) != F.substring("y", F.lit(1), first)
    order = (F.col("shorter") == 1) | (F.col("x") < F.col("y"))
    return met.where(order & differs & (F.levenshtein("x", "y", 1) == 1)).select("x", "x_n", "y", "y_n")


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form`` and ``form_n`` of every word."""
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("near"), F.col("y_n").alias("m")).unionAll(
        pairs.select("y", "x", "x_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    met = words.join(best, "word", "left")
    larger = -F.col("best.m") >= RATIO * F.col("n")
    return met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(larger, F.col("best.near")).alias("form"), F.when(larger, -F.col("best.m")).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """``found`` with ``root``: the end of the chain of forms of each word."""
    spark = found.sparkSession
    table = shared_folder(spark, "variants")
    found.write.parquet(table)
    found = spark.read.parquet(table)
    path = shared_folder(spark, "roots")
    found.where("form IS NOT NULL").select("word", F.col("form").alias("root")).write.parquet(path)
    while True:
        now = spark.read.parquet(path)
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # Both sides come from files, so that a root that many words lead to can be split.
        step = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        before, path = path, shared_folder(spark, "roots")
        step.write.parquet(path)
        moved = spark.read.parquet(path)
        delete(spark, before)
        if not moved.where("moved").limit(1).count():
            break
    ends = spark.read.parquet(path).select("word", "root")
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", garble: bool = False) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every frequent word.

    ``garble`` alters one occurrence in 97 by :func:`garbled`, for tests of recall.
    """
    spark = docs.sparkSession
    found = runs(docs, id_col, text_col).where(F.length("word") >= LEAST_LENGTH)
    if garble:
        found = found.select(garbled(F.col("doc_id"), F.col("word")).alias("word"))
    path = shared_folder(spark, "words")
    frequent(found).write.parquet(path)
    words = spark.read.parquet(path)
    return with_roots(forms(words, near_pairs(words)))
