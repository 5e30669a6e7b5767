"""What becomes of a message: disposition, quarantine, metrics, saved logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.scalars import preview

# Values of ``disposition``.
OK, NO_NAME, PARSE_ERROR, MODEL_ERROR, UNUSABLE, TOO_LARGE = (
    "ok", "no_session_name", "parse_error", "model_error", "unusable_response", "too_large",
)
# The JSON reader does not take every valid text above this many bytes.
READER_BYTES = 16 * 1024 * 1024


def with_disposition(
    rows: DataFrame, name: Column, parsed: Column, answered: Column | None = None,
    usable: Column | None = None,
) -> DataFrame:
    """Add ``disposition``, ``saved`` and ``retry``.

    A message without a session name and one whose model call failed come back
    later; one that cannot be parsed is consumed and goes to the quarantine,
    and so does one with an unusable response, if ``usable`` is given. A payload
    above ``READER_BYTES`` that cannot be parsed may be valid all the same: it
    is ``too_large``, and :func:`too_large` keeps it whole.
    """
    size = F.octet_length("payload") if "payload" in rows.columns else F.lit(0)
    answered = F.lit(True) if answered is None else answered
    usable = F.lit(True) if usable is None else usable
    return rows.withColumn(
        "disposition",
        F.when(F.coalesce(name, F.lit("")) == "", NO_NAME)
        .when(~parsed & (size > READER_BYTES), TOO_LARGE)
        .when(~parsed, PARSE_ERROR)
        .when(~answered, MODEL_ERROR)
        .when(~usable, UNUSABLE)
        .otherwise(OK),
    ).withColumns({
        "saved": F.col("disposition") == OK,
        "retry": F.col("disposition").isin(NO_NAME, MODEL_ERROR),
    })


def quarantine(rows: DataFrame) -> DataFrame:
    """Messages that are consumed but not saved, with the start of their payload."""
    return rows.where(F.col("disposition").isin(PARSE_ERROR, UNUSABLE)).select(
        "seq", "session_name", "disposition", preview(F.col("payload")).alias("payload_head")
    )


def too_large(rows: DataFrame) -> DataFrame:
    """Messages that the JSON reader could not take, with their whole payload."""
    return rows.where(F.col("disposition") == TOO_LARGE).select(
        "seq", "published", "subject", "headers", "session_name", "payload")


def latest(
    rows: DataFrame, name: str = "session_name", seq: str = "seq",
    then: tuple[str, ...] = ("published", "batch_id"),
) -> DataFrame:
    """The last message of every name; a repeated delivery counts once.

    Messages are in order of ``seq`` and, where numbers are equal or missing,
    of those columns of ``then`` that there are. Missing values come first, and
    messages without a name are one group. Only name and order are aggregated,
    with partial results in the map tasks. The wide rows then meet the winners
    on all of these columns, so a name that holds a third of all rows is no hot key.
    """
    order = [seq, *(c for c in then if c in rows.columns)]
    winners = rows.groupBy(name).agg(F.max(F.struct(*order)).alias("_last")).select(
        F.col(name).alias("_name"), *(F.col(f"_last.{c}").alias(f"_{c}") for c in order))
    same = rows[name].eqNullSafe(winners["_name"])
    for c in order:
        same = same & rows[c].eqNullSafe(winners[f"_{c}"])
    return rows.join(winners, same, "left_semi").dropDuplicates([name, *order])


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def with_latency(rows: DataFrame) -> DataFrame:
    """Time since publishing and time taken, in microseconds."""
    return rows.withColumns({
        "since_publish_us": micros_between(F.col("published"), F.col("finished")),
        "took_us": micros_between(F.col("started"), F.col("finished")),
    })


METRICS = (
    "seq", "session_name", "started", "published", "finished", "send_us", "build_and_call_us",
    "extra_info", "storage", "storage_us", "memo_hit", "memo_entries",
)


def metrics_rows(rows: DataFrame) -> DataFrame:
    """One statistics row per message; what was not measured is 0 or empty."""
    zero, defaults = F.lit(0).cast("bigint"), {}
    for c in ("send_us", "build_and_call_us", "storage_us", "memo_entries"):
        defaults[c] = F.coalesce(F.col(c), zero) if c in rows.columns else zero
    defaults["storage"] = F.coalesce("storage", F.lit("")) if "storage" in rows.columns else F.lit("")
    if "memo_hit" not in rows.columns:
        defaults["memo_hit"] = F.lit(False)
    if "extra_info" not in rows.columns:
        defaults["extra_info"] = F.create_map().cast("map<string,string>")
    out = rows.withColumns(defaults)
    return with_latency(out).select(*METRICS, "since_publish_us", "took_us")


def overhead(total_ms: Column, reported_ms: Column) -> Column:
    """What a call took beyond the time the model reported."""
    return total_ms - F.coalesce(reported_ms.try_cast("double"), F.lit(0.0))


def metrics_summary(rows: DataFrame) -> DataFrame:
    """Count and latency per disposition."""
    return rows.groupBy("disposition").agg(
        F.count("*").alias("messages"),
        F.min("since_publish_us").alias("min_us"),
        F.max("since_publish_us").alias("max_us"),
        F.sum("since_publish_us").alias("total_us"),
    )


def latency_percentiles(rows: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Approximate median and 95th percentile, with a sketch of bounded size."""
    return rows.groupBy("disposition").agg(
        F.percentile_approx("since_publish_us", [0.5, 0.95], accuracy).alias("p50_p95_us")
    )


def save_logs(rows: DataFrame, path: str, format: str = "json", mode: str = "append") -> None:
    """Write saved sessions, one row each: ``session_name``, ``seq``, ``log``.

    Sessions saved before stay; :func:`latest` picks the last one of a name.

    The path alone decides where they go (a local folder, ``s3a://…``, …).
    """
    rows.where(F.col("saved")).select("session_name", "seq", "log").write.format(format).mode(
        mode
    ).save(path)
