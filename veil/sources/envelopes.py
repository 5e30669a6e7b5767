"""Message envelopes: reading, routing, and what a header says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.schema import ENVELOPE, SESSION_HEADER

# Header that keeps the partition of a message whose source has several.
PARTITION_HEADER = "veil_partition"
# Published files; payloads repeat their texts and are a third or less of their length so.
COMPRESSION = "gzip"


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """A finite set of envelope files, one JSON object per line."""
    return spark.read.schema(ENVELOPE).json(path)


def stream_envelopes(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same files as an endless source.

    ``max_files_per_trigger`` bounds what one micro-batch takes, which is the
    back-pressure of this source.
    """
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def from_kafka_columns(records: DataFrame) -> DataFrame:
    """Bring rows of a Kafka source (with ``includeHeaders``) into envelope form.

    Of repeated headers the last one counts. Offsets start anew in every
    partition, so the partition travels in a header, and :func:`with_delivery_key`
    reads it.
    """
    own = F.struct(F.lit(PARTITION_HEADER).alias("key"), F.col("partition").cast("string").alias("value"))
    given = F.concat(
        F.transform(
            F.coalesce(F.col("headers"), F.array()),
            lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")),
        ),
        F.array(own),
    )
    last = F.filter(given, lambda h, i: ~F.exists(
        F.slice(given, i + 2, F.size(given)), lambda later: later["key"] == h["key"]))
    headers = F.map_from_entries(last)
    return records.select(
        F.col("offset").alias("seq"), F.col("timestamp").alias("published"),
        F.col("topic").alias("subject"), headers.alias("headers"),
        F.col("value").cast("string").alias("payload"),
    )


def full_subject(tenant: str, application: str, subject: str) -> str:
    return f"{tenant}.{application}.{subject}"


def of_subject(envelopes: DataFrame, tenant: str, application: str, subject: str) -> DataFrame:
    """Only the messages of one subject."""
    return envelopes.where(F.col("subject") == full_subject(tenant, application, subject))


def session_name(headers: Column | None = None) -> Column:
    """Name of the session; NULL where the header is missing or empty."""
    headers = F.col("headers") if headers is None else headers
    return F.nullif(F.try_element_at(headers, F.lit(SESSION_HEADER)), F.lit(""))


def with_defaults(envelopes: DataFrame) -> DataFrame:
    """Sequence 0 and the epoch for messages without broker information."""
    return envelopes.withColumns({
        "seq": F.coalesce("seq", F.lit(0).cast("bigint")),
        "published": F.coalesce("published", F.timestamp_seconds(F.lit(0))),
    })


def with_delivery_key(envelopes: DataFrame) -> DataFrame:
    """Add ``delivery_key``, equal for repeated deliveries of one message.

    Numbers repeat between subjects and partitions, and a message may have none:
    subject, partition, number, name and content together identify a delivery.
    """
    parts = (F.col("subject"), F.try_element_at("headers", F.lit(PARTITION_HEADER)),
             F.col("seq").cast("string"), session_name(), F.col("payload"))
    return envelopes.withColumn("delivery_key", F.sha2(F.to_json(F.array(*parts)), 256))


def first_delivery(envelopes: DataFrame) -> DataFrame:
    """One row per message, however often it was delivered."""
    return with_delivery_key(envelopes).dropDuplicates(["delivery_key"]).drop("delivery_key")


def publish(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Write envelopes where :func:`stream_envelopes` will find them.

    The files are compressed; each is read by one task, so there should be as many as tasks.
    """
    envelopes.select("seq", "published", "subject", "headers", "payload").write.mode(mode).json(
        path, compression=COMPRESSION)
