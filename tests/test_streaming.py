"""Streaming with a model: memo, retry, and what is written where."""

import json

from pyspark.sql import functions as F

from veil.plans.outcome import save_logs
from veil.schema import ENVELOPE
from veil.sources import envelopes as E
from veil.sources.responses import read_objects, read_response_files
from veil.sources.tables import shared_folder
from veil.streaming import jobs as J


def log(text):
    return json.dumps([{"role": "user", "content": text}])


def publish(spark, path, rows):
    data = [(seq, None, "s", {"session_log_name": name} if name else {}, payload)
            for seq, name, payload in rows]
    E.publish(spark.createDataFrame(data, ENVELOPE), path)


def factory_with(folder):
    """A model that writes down each text it is asked, and fails the first time for 'flaky'."""
    def factory():
        import os
        import uuid

        def answer(texts, prompt, model):
            out = []
            for t in texts:
                seen = any(t in open(f"{folder}/{f}").read() for f in os.listdir(folder))
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.write(t)
                if "flaky" in t and not seen:
                    raise RuntimeError("no answer")
                content = json.dumps({"redactions": {"Ann Lee": "[PERSON]", "Bob": "[NOPE]"}})
                out.append(json.dumps({"choices": [{"message": {"content": content}}]}))
            return out
        return answer
    return factory


def test_model_stream_remembers_and_retries(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    source, root = shared_folder(spark, "model-in"), shared_folder(spark, "model-out")
    tags = F.array(F.lit("[PERSON]"))

    def run():
        process = J.model_process(root, factory_with(str(asked)), "prompt", "m", tags)
        J.mask_stream(E.stream_envelopes(spark, source), root, process).awaitTermination()

    publish(spark, source, [(1, "a", log("I am Ann Lee, Bob")), (2, "b", log("I am Ann Lee, Bob")),
                            (3, "c", "broken"), (4, None, log("x"))])
    run()
    assert len(list(asked.iterdir())) == 1  # equal transcripts are asked once
    publish(spark, source, [(5, "d", log("I am Ann Lee, Bob")), (6, "e", log("flaky Ann Lee"))])
    run()
    # The known text came from the memo; the failed call was repeated at once.
    assert len(list(asked.iterdir())) == 3
    done = {r["session_name"]: r["log"] for r in J.latest_sessions(spark, root).collect()}
    assert set(done) == {"a", "b", "d", "e"}
    assert json.loads(done["d"])[0]["content"] == "I am [PERSON], Bob"
    assert json.loads(done["e"])[0]["content"] == "flaky [PERSON]"
    bad = spark.read.parquet(J.Folders(root).quarantine).collect()
    assert [(r["seq"], r["disposition"], r["payload_head"]) for r in bad] == [(3, "parse_error", "broken")]
    tries = spark.read.parquet(J.Folders(root).outcomes).where("seq = 4").orderBy("attempts").collect()
    # A nameless message comes back with every later batch, also one without new rows.
    assert {r["disposition"] for r in tries} == {"no_session_name"}
    assert [r["attempts"] for r in tries] == list(range(1, len(tries) + 1))
    assert 2 <= len(tries) <= J.MAX_ATTEMPTS


def test_a_repeated_batch_replaces_its_rows(spark):
    root = shared_folder(spark, "repeat")
    df = spark.createDataFrame([(1, None, "s", {"session_log_name": "a"}, log("call 415-555-9876"))], ENVELOPE)
    for _ in range(2):
        J.run_batch(df, 0, J.Folders(root), J.rules_process)
    rows = spark.read.parquet(J.Folders(root).sessions).collect()
    assert [json.loads(r["log"])[0]["content"] for r in rows] == ["call 415-5**-****"]


def test_old_messages_are_never_late(spark):
    source, root = shared_folder(spark, "late-in"), shared_folder(spark, "late-out")
    publish(spark, source, [(1, "a", "[]")])
    J.mask_stream(E.stream_envelopes(spark, source), root).awaitTermination()
    publish(spark, source, [(1, "a", "[]"), (2, "b", "[]"), (None, "c", "[]"), (None, "c", "[]")])
    J.mask_stream(E.stream_envelopes(spark, source), root).awaitTermination()
    names = [r["session_name"] for r in spark.read.parquet(J.Folders(root).sessions).collect()]
    assert sorted(names) == ["a", "b", "c"]


def test_files_as_objects_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.json").write_text('{\n"choices": []\n}')
    path = str(tmp_path / "in")
    assert bytes(read_objects(spark, path).first()["content"]).startswith(b"{\n")
    assert json.loads(read_response_files(spark, path).first()["response"]) == {"choices": []}
    rows = spark.createDataFrame([("a", 1, "[]", True), ("b", 2, "[]", False)],
                                 "session_name string, seq bigint, log string, saved boolean")
    for fmt in ("json", "parquet"):
        out = str(tmp_path / "out" / fmt)
        save_logs(rows, out, fmt)
        save_logs(rows, out, fmt)
        assert spark.read.format(fmt).load(out).count() == 2
        save_logs(rows, out, fmt, mode="overwrite")
        assert spark.read.format(fmt).load(out).count() == 1


def test_a_batch_keeps_payloads_only_where_a_table_takes_them(spark, tmp_path):
    source = str(tmp_path / "in")
    publish(spark, source, [(1, "a", log("ann@example.org")), (2, "b", "broken"), (3, None, log("x"))])
    kept, root = [], str(tmp_path / "out")

    def process(rows, batch_id):
        done = J.rules_process(rows, batch_id)
        kept.extend(r.asDict() for r in J.without_saved_payloads(done).select("seq", "payload", "saved").collect())
        return done

    J.run_batch(E.read_envelopes(spark, source), 0, J.Folders(root), process)
    assert {r["seq"]: r["payload"] for r in kept} == {1: None, 2: "broken", 3: log("x")}
    assert [r["payload"] for r in spark.read.parquet(f"{root}/pending").collect()] == [log("x")]
    assert [r["payload_head"] for r in spark.read.parquet(f"{root}/quarantine").collect()] == ["broken"]
    assert spark.read.parquet(f"{root}/sessions").count() == 1


def test_published_files_and_tables_are_compressed(spark, tmp_path):
    """Deliveries take the disk twice; before, they were plain text."""
    text = log("the same words again " * 5_000)
    publish(spark, str(tmp_path / "in"), [(i, f"n{i}", text) for i in range(8)])
    spark.read.text(str(tmp_path / "in")).write.mode("append").text(str(tmp_path / "in"), compression=E.COMPRESSION)
    assert sum(f.stat().st_size for f in (tmp_path / "in").rglob("part-*")) < 2 * len(text)
    assert E.read_envelopes(spark, str(tmp_path / "in")).where(F.col("payload") == text).count() == 16


def test_nothing_stays_of_settled_batches(spark, tmp_path):
    """Repeats are dropped across batches; before, what waited after each batch stayed for ever."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    first = [(0, "n0", "[]"), (9, None, "[]")]

    def process(rows, batch_id):
        name = E.session_name()
        return E.with_defaults(rows).select(
            "*", name.alias("session_name"), F.lit("ok").alias("disposition"), name.isNotNull().alias("saved"),
            name.isNull().alias("retry"), F.lit("found").alias("pair_status"), F.array().alias("pairs"), F.col("payload").alias("log"))

    for rows in (first, [(1, "n1", "[]")], first):
        data = [(seq, None, "s", {"session_log_name": name} if name else {}, p) for seq, name, p in rows]
        E.publish(spark.createDataFrame(data, ENVELOPE).coalesce(1), source)
    J.mask_stream(E.stream_envelopes(spark, source, max_files_per_trigger=1), root, process, max_attempts=3).awaitTermination()
    done = spark.read.parquet(f"{root}/sessions")
    assert sorted(r.session_name for r in done.collect()) == ["n0", "n1"]
    assert done.select("batch_id").distinct().count() > 1
    tried = spark.read.parquet(f"{root}/outcomes").where("retry").orderBy("attempts").collect()
    assert [r.attempts for r in tried] == list(range(1, len(tried) + 1)) and 1 <= len(tried) <= 3
    left = [int(p.name.rpartition("=")[2]) for p in (tmp_path / "out" / "pending").glob("batch_id=*")]
    assert len(left) <= 2 and not list((tmp_path / "out" / "kept").glob("batch_id=*"))


def test_a_batch_is_not_kept_in_the_memory_of_executors(spark, tmp_path, monkeypatch):
    publish(spark, str(tmp_path / "in"), [(1, "a", log("ann@example.org")), (2, None, log("x"))])
    before, seen, usual = spark.sparkContext._jsc.getPersistentRDDs().size(), [], J.quarantine

    def looked_at(done):
        done.count()
        seen.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return usual(done)

    monkeypatch.setattr(J, "quarantine", looked_at)
    J.run_batch(E.read_envelopes(spark, str(tmp_path / "in")), 0, J.Folders(str(tmp_path / "out")), J.rules_process)
    assert seen == [before]
    kept = spark.read.parquet(str(tmp_path / "out" / "sessions")).collect()
    assert [(r.session_name, r.n_pairs) for r in kept] == [("a", 1)]
