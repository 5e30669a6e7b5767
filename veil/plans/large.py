"""Masking of logs that are too long for one row.

The log is cut into entries (:mod:`veil.sources.splitter`), entries are read, searched and
rewritten like small logs, and what was found in any of them is applied to all.
The result has a row per entry. A log is valid, as a small one is, if it is one array and every
entry has a known shape; an entry itself must be short enough for the JSON reader.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.operators.detect import detect
from veil.operators.rewrite import log_texts, mask_log, with_present_pairs
from veil.schema import OPERATORS, Operator
from veil.sources.envelopes import session_name, with_defaults
from veil.sources.logs import entry_json, with_log
from veil.sources.splitter import split_logs
from veil.sources.tables import stored


def mask_large(envelopes: DataFrame, operators: Iterable[Operator] = OPERATORS, deep: bool = False) -> DataFrame:
    """``row_id``, ``seq``, ``session_name``, ``pos``, ``kind`` and masked ``entry`` of every valid log with a name.

    Logs of any length give the rows that the job on whole logs gives; repeated deliveries are
    kept apart by ``row_id``.
    """
    named = with_defaults(envelopes).withColumn("session_name", session_name()).where(F.col("session_name").isNotNull())
    keyed = named.withColumn("row_id", F.monotonically_increasing_id())
    pieces = stored(split_logs(keyed, ["row_id", "seq", "session_name"]), "large-entries")
    single = pieces.where("entry IS NOT NULL").withColumn("payload", F.concat(F.lit("["), "entry", F.lit("]")))
    read = with_log(single, "payload", "log").withColumn("known", F.size("log") == 1).drop("payload", "entry")
    bad = read.where(~F.coalesce("known", F.lit(False))).select("row_id").unionAll(pieces.where("NOT whole").select("row_id")).distinct()
    good = stored(read.join(bad, "row_id", "left_anti"), "large-logs")
    turns = good.select(F.col("row_id").alias("session_id"), F.col("pos").alias("turn"), F.lit("user").alias("role"),
                        log_texts(F.col("log")).alias("text"), "seq", "session_name", "log")
    pairs = detect(turns.select("session_id", "turn", "role", "text"), tuple(operators))
    masked = with_present_pairs(turns, pairs)
    out = masked.withColumn("log", mask_log(F.col("log"), F.col("pairs"), deep))
    entry = F.get(F.col("log"), F.lit(0))
    return out.select(F.col("session_id").alias("row_id"), "seq", "session_name", F.col("turn").alias("pos"),
                      entry["kind"].alias("kind"), entry_json(entry).alias("entry"))
