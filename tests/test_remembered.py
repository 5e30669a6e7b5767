"""Answers in the state of a stream: asked once, forgotten, and tried again without new input."""

import json
import sys
import time
from datetime import timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veil.streaming import remembered as R

# Tasks cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def factory_of(folder, fails):
    """A model that writes down every text, and fails so many times for a text."""
    def factory():
        import os
        import uuid

        def answer(texts, prompt, model):
            out = []
            for t in texts:
                asked = sum(open(f"{folder}/{f}").read() == t for f in os.listdir(folder))
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.write(t)
                if asked < fails.get(t, 0):
                    raise RuntimeError("no answer")
                out.append(json.dumps({"of": t}))
            return out
        return answer
    return factory


@pytest.fixture
def store(spark):
    R.use_state_store(spark)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(spark, tmp_path, factory, settings, n):
    """Run the stream until ``n`` messages have come out; timers keep it running by themselves."""
    stream = spark.readStream.schema("message string, text string").json(str(tmp_path / "in"))
    query = R.remembered_answers(stream, factory, "p", "m", settings).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "checkpoint")).outputMode("append").trigger(processingTime="300 milliseconds").start(str(tmp_path / "out"))
    try:
        until, done = time.time() + 60, 0
        while time.time() < until and done < n:
            time.sleep(1)
            assert query.exception() is None
            done = spark.read.schema(R.OUTPUT).parquet(str(tmp_path / "out")).select("message").distinct().count()
    finally:
        query.stop()
    return {r.message: r for r in spark.read.schema(R.OUTPUT).parquet(str(tmp_path / "out")).collect()}


def put(spark, tmp_path, rows):
    spark.createDataFrame(rows, "message string, text string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))


def asked(tmp_path):
    return sorted(f.read_text() for f in (tmp_path / "asked").iterdir())


def test_memo_lives_in_the_state_and_is_forgotten(spark, store, tmp_path):
    (tmp_path / "asked").mkdir()
    factory = factory_of(str(tmp_path / "asked"), {})
    put(spark, tmp_path, [("1", "a"), ("2", "a"), ("3", "b"), ("4", None)])
    run(spark, tmp_path, factory, R.Settings(), 4)
    assert asked(tmp_path) == ["a", "b"]
    put(spark, tmp_path, [("5", "a"), ("6", "c")])
    rows = run(spark, tmp_path, factory, R.Settings(), 6)
    assert rows["4"].status == "unasked" and asked(tmp_path) == ["a", "b", "c"]  # the second job found the answer in the state
    assert set(rows) == set("123456") and rows["5"].from_memo and not rows["6"].from_memo
    assert json.loads(rows["5"].response) == {"of": "a"} and rows["5"].text_key == R.text_key("a")


def test_answers_of_a_short_life_are_asked_again(spark, store, tmp_path):
    (tmp_path / "asked").mkdir()
    factory = factory_of(str(tmp_path / "asked"), {})
    for k in range(2):
        put(spark, tmp_path, [(str(k), "a")])
        run(spark, tmp_path, factory, R.Settings(ttl=timedelta(milliseconds=1)), k + 1)
    assert asked(tmp_path) == ["a", "a"]


def test_failed_calls_are_tried_again_without_new_input(spark, store, tmp_path):
    (tmp_path / "asked").mkdir()
    factory = factory_of(str(tmp_path / "asked"), {"flaky": 2, "dead": 99})
    put(spark, tmp_path, [("1", "flaky"), ("2", "flaky"), ("3", "dead"), ("4", "fine")])
    done = run(spark, tmp_path, factory, R.Settings(delay=timedelta(milliseconds=100), max_tries=4), 4)
    assert {m: (r.status, r.tries) for m, r in done.items()} == {
        "1": ("answered", 3), "2": ("answered", 3), "3": ("gave_up", 4), "4": ("answered", 1)}
    assert done["3"].response is None
    assert asked(tmp_path) == ["dead"] * 4 + ["fine"] + ["flaky"] * 3


def test_delays_double():
    s = R.Settings(delay=timedelta(seconds=10))
    assert [s.wait_ms(k) for k in (1, 2, 3)] == [10_000, 20_000, 40_000]


def test_hot_text_in_many_parts(spark, store, tmp_path):
    (tmp_path / "asked").mkdir()
    spark.range(30_000).select(F.col("id").cast("string").alias("message"), F.lit("same").alias("text")).write.json(str(tmp_path / "in"))
    rows = run(spark, tmp_path, factory_of(str(tmp_path / "asked"), {}), R.Settings(), 30_000)
    assert asked(tmp_path) == ["same"] and len(rows) == 30_000


def test_job_with_state_masks_retries_and_gives_up(spark, store, tmp_path):
    from veil.schema import ENVELOPE
    from veil.sources import envelopes as E
    from veil.streaming import jobs as J

    def log(text):
        return json.dumps([{"role": "user", "content": text}])

    def factory():
        def answer(texts, prompt, model):
            if "dead" in texts[0]:
                raise RuntimeError("no answer")
            return [json.dumps({"choices": [{"message": {"content": json.dumps({"redactions": {"Ann Lee": "[PERSON]"}})}}]})]
        return answer

    rows = [(1, "a", log("I am Ann Lee")), (2, "b", log("dead Ann Lee")), (3, "c", "broken"), (4, None, log("x")), (5, "d", log("I am Ann Lee"))]
    E.publish(spark.createDataFrame([(n, None, "s", {"session_log_name": name} if name else {}, p) for n, name, p in rows], ENVELOPE), str(tmp_path / "in"))
    query = J.remembered_stream(
        E.stream_envelopes(spark, str(tmp_path / "in")), str(tmp_path / "job"), factory, "p", "m", F.array(F.lit("[PERSON]")),
        R.Settings(delay=timedelta(milliseconds=100), max_tries=2), trigger={"processingTime": "300 milliseconds"})
    outcomes = lambda: {r.seq: r.disposition for r in spark.read.schema("seq bigint, disposition string").parquet(str(tmp_path / "job" / "outcomes")).collect()}
    try:
        until = time.time() + 90
        while time.time() < until:
            time.sleep(1)
            assert query.exception() is None
            if (tmp_path / "job" / "outcomes").exists() and len(outcomes()) == 5:
                break
    finally:
        query.stop()
    assert outcomes() == {1: "ok", 2: "model_error", 3: "parse_error", 4: "no_session_name", 5: "ok"}
    saved = {r.session_name: r.log for r in J.latest_sessions(spark, str(tmp_path / "job")).collect()}
    assert set(saved) == {"a", "d"} and json.loads(saved["d"])[0]["content"] == "I am [PERSON]"
    gave_up = spark.read.parquet(str(tmp_path / "job" / "gave_up")).collect()
    assert sorted(r.seq for r in gave_up) == [2, 4]
