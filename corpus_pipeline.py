"""The corpus pipeline: filter, clean, deduplicate, mask and pack the documents.

Every stage works on what the one before it kept and takes its own decisions into
effect. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.llm import lines, packing, pii, quality, simhash
from veil.llm.common import stored
from veil.llm.queries import VOCABULARY
from veil.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    docs = docs.select(*COLUMNS)
    return quality.keep_documents(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut; documents that had nothing else go."""
    cut = lines.dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"[ \t-\r]+", "")) == "")
    return _columns(cut.where(~F.coalesce(emptied, F.lit(False))))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates by SimHash one document stays."""
    return simhash.keep_one(docs.select(*COLUMNS))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in every text."""
    docs = docs.select(*COLUMNS)
    return _columns(pii.mask(docs, pii.fit(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole texts are packed into sequences of tokens."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near", near_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier and a conditional random field are no SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL: str | None = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
