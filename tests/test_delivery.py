"""Identity and order of messages."""

import datetime as dt

from pyspark.sql import functions as F

from veil.plans import outcome
from veil.plans.outcome import latest, save_logs
from veil.sources.envelopes import first_delivery, from_kafka_columns
from veil.streaming.jobs import write_batch

T0 = dt.datetime(2024, 5, 1)
RECORD = "topic string, partition int, offset bigint, timestamp timestamp, value binary, headers array<struct<key string, value binary>>"


def records(spark, rows):
    return spark.createDataFrame([(t, p, o, T0, v.encode(), h) for t, p, o, v, h in rows], RECORD)


def test_equal_offsets_of_two_partitions_are_two_messages(spark):
    df = from_kafka_columns(records(spark, [("s", 0, 5, "a", None), ("s", 1, 5, "a", None), ("s", 0, 5, "a", None), ("r", 0, 5, "a", None)]))
    assert first_delivery(df).count() == 3


def test_of_repeated_headers_the_last_counts(spark):
    df = from_kafka_columns(records(spark, [("s", 2, 1, "x", [("k", b"1"), ("m", b"2"), ("k", b"3")])]))
    assert df.first()["headers"] == {"m": "2", "k": "3", "veil_partition": "2"}


def test_messages_without_number_are_told_apart_by_content(spark):
    rows = [(None, "s", None, "a"), (None, "s", None, "a"), (None, "s", None, "b"), (None, None, None, None), (1, "s", None, "a"), (1, "s", None, "b")]
    df = spark.createDataFrame(rows, "seq bigint, subject string, headers map<string,string>, payload string")
    assert first_delivery(df).count() == 5


def test_latest_keeps_missing_names_and_breaks_ties(spark):
    rows = [("a", 1, 1, "old"), ("a", 2, 1, "x"), ("a", 2, 3, "new"), (None, 1, 1, "p"), (None, 4, 1, "q"), ("b", None, 1, "r"), ("b", None, 2, "s"), ("c", 7, 7, "t"), ("c", 7, 7, "t")]
    df = spark.createDataFrame(rows, "session_name string, seq bigint, batch_id int, v string")
    got = {r.session_name: r.v for r in latest(df).collect()}
    assert got == {"a": "new", None: "q", "b": "s", "c": "t"} and latest(df).count() == 4


def test_saving_keeps_what_was_saved_before(spark, tmp_path):
    for name in ("one", "two"):
        save_logs(spark.createDataFrame([(name, 1, "log", True)], "session_name string, seq int, log string, saved boolean"), str(tmp_path / "out"))
    assert {r.session_name for r in spark.read.json(str(tmp_path / "out")).collect()} == {"one", "two"}


def test_a_repeated_batch_replaces_rows_also_by_none(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    write_batch(df, path, 1)
    write_batch(df, path, 2)
    write_batch(df.limit(0), path, 2)
    got = spark.read.schema("id bigint, batch_id int").parquet(path)
    assert got.where("batch_id = 1").count() == 3 and got.where(F.col("batch_id") == 2).count() == 0


def test_a_large_payload_is_kept(spark, monkeypatch):
    monkeypatch.setattr(outcome, "READER_BYTES", 100)
    rows = spark.createDataFrame([(1, "n", "x" * 200), (2, "n", "x"), (3, "n", "[]")], "seq int, session_name string, payload string").selectExpr(
        "*", "current_timestamp() AS published", "'s' AS subject", "map('a', 'b') AS headers")
    done = outcome.with_disposition(rows, F.col("session_name"), F.col("payload") == "[]")
    assert {r.seq: r.disposition for r in done.collect()} == {1: "too_large", 2: "parse_error", 3: "ok"}
    assert [r.payload for r in outcome.too_large(done).collect()] == ["x" * 200]
