"""Endless masking: envelopes in, masked sessions out.

Every micro-batch runs the batch job on its rows. Its results go to folders
partitioned by ``batch_id``; a batch that is repeated after a failure
overwrites its own partitions, so with the checkpoint a message is neither
lost nor written twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veil.operators import model as model_ops
from veil.plans.large import mask_large
from veil.operators.pairs import with_pairs
from veil.plans.mask import askable, finish, mask_answered, mask_sessions, parsed, with_transcripts
from veil.plans.outcome import latest, quarantine, too_large
from veil.schema import ENVELOPE
from veil.sources.envelopes import with_delivery_key
from veil.streaming.remembered import Settings, remembered_answers

PENDING = f"{ENVELOPE}, attempts INT"
LARGE = f"{ENVELOPE}, session_name STRING"
MEMO = "text_key STRING, text STRING, response STRING, responded_at TIMESTAMP"
# How long a delivery is remembered; bounds the state of the stream.
REMEMBER = "1 day"
MAX_ATTEMPTS = 5
# Logs repeat themselves; small row groups keep little of them in the memory of a task.
TABLE = {"compression": "zstd", "parquet.block.size": str(16 << 20)}

# A batch job: envelopes and the number of the batch to masked rows.
Process = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class Folders:
    """Where a job keeps its results, all below one shared folder."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove the rows of a batch that nothing needs any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_repeats(stream: DataFrame, remember: str = REMEMBER) -> DataFrame:
    """Drop repeated deliveries on a stream.

    The watermark runs on the time of arrival, so no message is ever late,
    however old it is; ``remember`` only bounds the state.
    """
    return (
        with_delivery_key(stream)
        .withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", remember)
        .dropDuplicatesWithinWatermark(["delivery_key"])
        .drop("delivery_key", "_arrived")
    )


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows of a batch; writing the same batch again replaces them, also by none."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**TABLE).parquet(
        f"{path}/batch_id={batch_id}")


def without_saved_payloads(done: DataFrame) -> DataFrame:
    """Masked rows without the payloads that no table takes: half of what a batch would keep."""
    spent = F.col("saved") & ~F.col("retry")
    return done.withColumn("payload", F.when(~F.coalesce(spent, F.lit(False)), F.col("payload")))


def pending_of(spark: SparkSession, folders: Folders, batch_id: int) -> DataFrame | None:
    """What the batch before this one left to be tried again."""
    path = f"{folders.pending}/batch_id={batch_id - 1}"
    return spark.read.schema(PENDING).parquet(path) if path_exists(spark, path) else None


def run_batch(
    batch: DataFrame, batch_id: int, folders: Folders, process: Process,
    max_attempts: int = MAX_ATTEMPTS,
) -> None:
    """Process one micro-batch and write sessions, quarantine, metrics, pending.

    Rows to be retried join the next batch, up to ``max_attempts`` times; then
    they are written to ``gave_up``, so that no message disappears. The masked rows are
    written once for all tables, and removed when these are there: a batch may be
    larger than the memory of the executors.
    """
    spark = batch.sparkSession
    rows = batch.withColumn("attempts", F.lit(0))
    waiting = pending_of(spark, folders, batch_id)
    if waiting is not None:
        rows = rows.unionByName(waiting)
    # The batch job is given plain envelopes; attempts travel in a header.
    tagged = rows.withColumn("headers", F.map_concat(
        F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")),
                     lambda k, _: k != "veil_attempts"),
        F.create_map(F.lit("veil_attempts"), F.col("attempts").cast("string")),
    )).drop("attempts")
    done = without_saved_payloads(process(tagged, batch_id)).withColumns({
        "attempts": F.try_element_at("headers", F.lit("veil_attempts")).cast("int") + 1,
        "headers": F.map_filter("headers", lambda k, _: k != "veil_attempts"),
        # How many pairs, not which: the values are what was masked.
        "n_pairs": F.size("pairs"),
    }).drop("pairs")
    try:
        write_batch(done, folders.kept, batch_id)
        done = spark.read.schema(done.schema).parquet(f"{folders.kept}/batch_id={batch_id}")
        write_batch(
            done.where("saved").select("session_name", "seq", "published", "log", "n_pairs"),
            folders.sessions, batch_id,
        )
        write_batch(quarantine(done), folders.quarantine, batch_id)
        write_batch(too_large(done), folders.too_large, batch_id)
        large = spark.read.schema(LARGE).parquet(f"{folders.too_large}/batch_id={batch_id}")
        if not large.isEmpty():  # else no pass for logs that are not there
            write_batch(mask_large(large), folders.large_sessions, batch_id)
        write_batch(
            done.select("seq", "session_name", "disposition", "saved", "retry", "pair_status",
                        "published", F.current_timestamp().alias("finished"), "attempts"),
            folders.outcomes, batch_id,
        )
        again = done.where("retry").select(
            "seq", "published", "subject", "headers", "payload", "attempts"
        )
        write_batch(again.where(F.col("attempts") < max_attempts), folders.pending, batch_id)
        write_batch(again.where(F.col("attempts") >= max_attempts), folders.gave_up, batch_id)
    finally:
        drop_batch(spark, folders.kept, batch_id)
    # What this batch took in must stay until it is committed; the batch before is.
    drop_batch(spark, folders.pending, batch_id - 2)


def rules_process(rows: DataFrame, batch_id: int) -> DataFrame:
    return mask_sessions(rows)


def lists_process(terms: DataFrame | None = None, allow: DataFrame | None = None) -> Process:
    """Batch job with the rules, listed terms (term, operator) and values that stay (value)."""
    return lambda rows, batch_id: mask_sessions(rows, terms=terms, allow=allow)


def mask_stream(
    envelopes: DataFrame, root: str, process: Process = rules_process,
    remember: str | None = REMEMBER, max_attempts: int = MAX_ATTEMPTS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job on a stream of envelopes, below the shared folder ``root``.

    ``trigger`` is passed to the writer; the default processes what is there
    and stops. Without ``remember`` the stream is stateless and repeated
    deliveries are settled by :func:`latest_sessions` alone.
    """
    folders = Folders(root)
    source = drop_repeats(envelopes, remember) if remember else envelopes
    return (
        source.writeStream.option("checkpointLocation", folders.checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda df, i: run_batch(df, i, folders, process, max_attempts))
        .start()
    )


def model_process(
    root: str, factory: model_ops.Factory, prompt: str, model: str, tags: Column | None = None,
    on_unparsed: str = "quarantine",
) -> Process:
    """Batch job with a model, and a memo of its answers below ``root``.

    Answers are written before they are used: the model is asked once per
    distinct text even if later stages are repeated, and the written table cuts
    the lineage. Failed calls are not written, so their messages come back.
    """
    folders = Folders(root)

    def process(rows: DataFrame, batch_id: int) -> DataFrame:
        spark = rows.sparkSession
        # One time for the whole batch: what is live when it is looked up stays so.
        now = F.lit(spark.sql("SELECT current_timestamp()").first()[0])
        messages = with_transcripts(rows)
        asked = askable(messages)
        known = None
        if path_exists(spark, folders.memo):
            stored = spark.read.schema(f"{MEMO}, batch_id INT").parquet(folders.memo)
            known = model_ops.live_memo(stored.where(F.col("batch_id") < batch_id), now)
        fresh = model_ops.answers(asked, factory, prompt, model, known)
        write_batch(model_ops.memo_rows(fresh, now), folders.memo, batch_id)
        own = spark.read.schema(f"{MEMO}, batch_id INT").parquet(folders.memo).where(
            F.col("batch_id") == batch_id
        )
        answered = own.select("text_key", "text", "response")
        if known is not None:
            answered = answered.unionByName(known.select("text_key", "text", "response"))
        return mask_answered(messages, answered, tags, on_unparsed)

    return process


def remembered_stream(
    envelopes: DataFrame, root: str, factory: model_ops.Factory, prompt: str, model: str,
    tags: Column | None = None, settings: Settings = Settings(), on_unparsed: str = "quarantine",
    remember: str | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Mask a stream with a model whose memo and retries are state of the stream.

    Answers live for ``settings.ttl`` and are never scanned; messages whose call failed wait
    in the state until a timer asks again, also without new input, and go to ``gave_up``
    after ``settings.max_tries``. Messages without a session name go there at once. The
    query runs until it is stopped. Needs :func:`veil.streaming.remembered.use_state_store`.
    """
    folders = Folders(root)
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    source = drop_repeats(envelopes, remember) if remember else envelopes
    rows = with_transcripts(source)
    askable_text = F.when(F.col("entries").isNotNull() & F.col("session_name").isNotNull(), F.col("text"))
    fields = [f.name for f in envelopes.schema.fields]
    messages = rows.select(F.to_json(F.struct(*fields), exact).alias("message"), askable_text.alias("text"))
    answered = remembered_answers(messages, factory, prompt, model, settings)

    def write(batch: DataFrame, batch_id: int) -> None:
        given = batch.select(F.from_json("message", ENVELOPE, exact).alias("m"), "response").select("m.*", "response")
        done = without_saved_payloads(
            finish(with_pairs(parsed(given), "response", tags), F.col("response").isNotNull(), on_unparsed)).persist()
        try:
            write_batch(done.where("saved").select(
                "session_name", "seq", "published", "log", F.size("pairs").alias("n_pairs")), folders.sessions, batch_id)
            write_batch(quarantine(done), folders.quarantine, batch_id)
            write_batch(too_large(done), folders.too_large, batch_id)
            write_batch(done.select("seq", "session_name", "disposition", "saved", "retry", "pair_status", "published",
                                    F.current_timestamp().alias("finished")), folders.outcomes, batch_id)
            write_batch(done.where("retry").select(*fields), folders.gave_up, batch_id)
        finally:
            done.unpersist()

    return (
        answered.writeStream.option("checkpointLocation", folders.checkpoint).outputMode("append")
        .trigger(**(trigger or {"processingTime": "10 seconds"})).foreachBatch(write).start()
    )


def latest_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Masked sessions written so far; the last message of a name wins."""
    return latest(spark.read.parquet(Folders(root).sessions))
