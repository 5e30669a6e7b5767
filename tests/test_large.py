"""Logs that are cut into entries."""

import json
import random

import pytest
from pyspark.sql import functions as F

from veil.plans import outcome
from veil.plans.large import mask_large
from veil.plans.mask import mask_sessions
from veil.schema import ENVELOPE
from veil.sources import splitter
from veil.sources.envelopes import publish, stream_envelopes
from veil.streaming.jobs import mask_stream


def pieces(text, block):
    machine, out = splitter.Splitter(), []
    data = text.encode()
    for at in range(0, len(data), block):
        out += machine.feed(data[at : at + block])
    return [e.decode() for e in out], machine.valid


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_entries_at_every_block_size(block):
    rng = random.Random(block)
    for _ in range(60):
        entries = [rng.choice([
            {"a": '[,]"\\', "b": [1, {"c": "]}"}]}, "x\\\\", 'q"', {"é": "\\\"😀"}, [], {}, 5, None, [[["\\"]]], "a,b",
        ]) for _ in range(rng.randrange(6))]
        text = rng.choice(["", " \n"]) + json.dumps(entries, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) + rng.choice(["", "\n "])
        got, valid = pieces(text, block)
        assert valid and [json.loads(e) for e in got] == entries


@pytest.mark.parametrize("text", ["", "  ", "{}", "[", "[1", "[1,]", "[,1]", "[1]]", "[1] x", "x[1]", "[1}", '["a]', "null"])
@pytest.mark.parametrize("block", [1, 50])
def test_what_is_no_array_is_not_valid(text, block):
    assert not pieces(text, block)[1]


def message(text, turn):
    return {"role": "user", "content": text, "turn": turn, "tool_calls": [
        {"index": 0, "id": "c", "type": "function", "function": {"name": "f", "arguments": json.dumps({"q": text})}}]}


def envelope(name, payload, seq=1):
    return (seq, None, "s", {"session_log_name": name}, payload)


def entries_of(rows):
    return sorted((r.session_name, r.seq, r.pos, r.entry) for r in rows)


def test_same_rows_as_small_logs(spark):
    logs = {
        "a": [message("My name is Ann Lee.", 0), message("Ann Lee has mail ann@b.org", 1), message("call Ann Lee", 2)],
        "b": [message("nothing", 0)], "c": [], "d": [{"unknown": 1}], "e": [message("ann@b.org", 0), 5],
    }
    rows = [envelope(n, json.dumps(x), i) for i, (n, x) in enumerate(logs.items())]
    rows += [envelope("f", "[1", 8), envelope("g", None, 9), envelope("", json.dumps(logs["a"]), 10), envelope("a", json.dumps(logs["a"]), 0)]
    df = spark.createDataFrame(rows, ENVELOPE)
    done = mask_sessions(df).where("saved").select("session_name", "seq", F.posexplode(F.from_json("log", "array<string>")).alias("pos", "entry"))
    got = entries_of(mask_large(df).collect())
    assert [(n, s, p, json.loads(e)) for n, s, p, e in got] == [(n, s, p, json.loads(e)) for n, s, p, e in entries_of(done.collect())]
    assert len(got) == 2 * 3 + 1 and "Ann Lee" not in str(got) and "ann@b.org" not in str(got)


def test_a_log_far_above_the_reader_is_masked(spark, tmp_path):
    """Some 200 MB: found in one entry, masked in all."""
    filler = "plain words without anything in them " * 270
    n = 20_000
    parts = [json.dumps({"role": "user", "content": ("my name is Zoe Quist. " if k == n - 1 else "ask Zoe Quist. ") + filler, "turn": k}) for k in range(n)]
    payload = "[" + ",".join(parts) + "]"
    assert len(payload) > 190 << 20
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "big.txt", "w") as f:
        f.write(payload)
    df = spark.read.text(str(tmp_path / "in"), wholetext=True).select(
        F.lit(1).cast("bigint").alias("seq"), F.lit(None).cast("timestamp").alias("published"), F.lit("s").alias("subject"),
        F.create_map(F.lit("session_log_name"), F.lit("big")).alias("headers"), F.col("value").alias("payload"))
    rows = mask_large(df).agg(
        F.count("*").alias("n"), F.sum(F.contains("entry", F.lit("Zoe Quist")).cast("int")).alias("clear"),
        F.sum(F.contains("entry", F.lit("[PERSON]")).cast("int")).alias("masked"), F.sum(F.length("entry")).alias("size")).first()
    assert (rows.n, rows.clear, rows.masked) == (n, 0, n) and rows["size"] > 190 << 20


def test_a_stream_masks_what_is_too_large(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(outcome, "READER_BYTES", 10)
    bad = json.dumps([message("ann@b.org", 0)]) + " "
    publish(spark.createDataFrame([envelope("a", bad, 1), envelope("b", "[" + bad, 2)], ENVELOPE), str(tmp_path / "in"))
    mask_stream(stream_envelopes(spark, str(tmp_path / "in")), str(tmp_path / "job")).awaitTermination()
    saved = spark.read.parquet(str(tmp_path / "job" / "sessions")).collect()
    assert [r.session_name for r in saved] == ["a"] and "ann@b.org" not in saved[0].log
    kept = spark.read.parquet(str(tmp_path / "job" / "too_large")).collect()
    assert [r.session_name for r in kept] == ["b"]
    assert spark.read.schema("entry string").parquet(str(tmp_path / "job" / "large_sessions")).count() == 0
