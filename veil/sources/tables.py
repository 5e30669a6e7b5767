"""Reading the driver tables and shared folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Below this many bytes per core a table is too small to be split by the reader.
SMALL_PER_CORE = 16 * 1024 * 1024


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_if_small(df: DataFrame) -> DataFrame:
    """Give a small input to all cores.

    A parquet row group is read by one task, so a table of a few megabytes is
    one task however many cores there are. Detection is bound by CPU, so such
    a table is spread over the cores first. The size is checked: a table that
    the reader can split by itself passes unchanged and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < SMALL_PER_CORE * cores else df


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    For a result that several branches of a plan need: it is computed once, it
    survives the loss of executors, and its size is known from here on.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder that all executors see.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="veil-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
