"""Connected components of a link table by alternating star contractions.

No link, component or node list passes through the driver: each round is two joins of
the links with the least neighbour of every node, written to the shared folder so that
the next round starts from files. The number of rounds grows with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import delete, shared_folder

#: Far beyond the logarithm of any table; reached only if a round stopped contracting.
MAX_ROUNDS = 60


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of every node with its least neighbour."""
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select(F.col("b"), F.col("a")))
    else:
        near = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = near.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select("u", "m"))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node of its component) of every node in ``links`` (a, b).

    Nodes are compared by Spark's order. Links with a null end, loops and repeated links
    count for nothing; an empty table gives an empty table.
    """
    spark = links.sparkSession
    path = shared_folder(spark, "links")
    links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().write.parquet(path)
    seen = None
    for _ in range(MAX_ROUNDS):
        now = spark.read.parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, before, path = state, path, shared_folder(spark, "links")
        _stars(_stars(now, large=True), large=False).write.parquet(path)
        delete(spark, before)
    else:
        raise RuntimeError("components did not settle")
    return spark.read.parquet(path).select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        spark.read.parquet(path).select(F.col("b"), F.col("b")).distinct()
    )
