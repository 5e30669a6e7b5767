"""Recorded model responses as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_responses(spark: SparkSession, path: str, keys: str = "session_name STRING") -> DataFrame:
    """Responses stored one JSON object per line: the keys and ``response``."""
    return spark.read.schema(f"{keys}, response STRING").json(path)


def read_response_files(spark: SparkSession, path: str) -> DataFrame:
    """One response per file, named by its path: ``(path, response)``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.input_file_name().alias("path"), F.col("value").alias("response"))


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Whole objects as bytes: ``(path, content)``."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
