"""Tables with every awkward case, for the tests of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = "word " * 40_000 + "x" * 30_000
#: Columns that operators use inside, to clash with.
CLASHING = ("h", "bucket", "fp", "digest", "rank", "n", "doc", "at", "kept", "score", "length", "label", "root", "node", "u", "v", "c", "n_lines", "n_removed", "predicted", "spans", "ids", "piece", "__print", "__digest", "__id", "__windows")


def awkward(spark: SparkSession, more: list[tuple[int | None, str | None]] = ()) -> DataFrame:
    """Null and empty texts, repeated rows, a null id, a very long text, clashing columns."""
    rows = [(1, "same text"), (2, None), (3, ""), (4, "same text"), (4, "same text"), (None, "same text"), (None, None), (5, LONG), (6, LONG), (7, "é ß 一 😀"), *more]
    return clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))


def clashing(df: DataFrame) -> DataFrame:
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHING if c not in df.columns))


def empty(spark: SparkSession) -> DataFrame:
    return clashing(spark.createDataFrame([], "doc_id bigint, text string"))
