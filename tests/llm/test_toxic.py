import binascii
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from veil.llm import toxic

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxic.fit(docs, labels)


def test_held_out_documents(learnt):
    docs, labels, model = learnt
    rows = toxic.score_documents(docs, model).join(labels, "doc_id").where(toxic.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 700 and all(binascii.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    bad = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in bad) >= 0.9 * len(bad)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.005 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_passages_are_places_of_the_text(learnt):
    docs, _, model = learnt
    found = toxic.passages(docs, model).join(docs, "doc_id").limit(300).collect()
    assert found
    for r in found:
        assert r.text[r.start : r.end] == r.passage and r.expected <= toxic.CHANCE
        words = toxic.tokens(pa.array([r.passage])).words.to_pylist()
        assert set(words) & set(model.words)
    flagged = {r.doc_id for r in toxic.passages(docs, model).select("doc_id").distinct().collect()}
    floor = float(model.probability(np.zeros(1))[0])
    above = {r.doc_id for r in toxic.score_documents(docs, model).where(F.col("score") > floor).collect()}
    assert flagged == above


def brute_segments(scores):
    """Maximal segments by their definition: split off the best segment, go on on both sides."""
    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (top is None or total > top[0] + 1e-12 or abs(total - top[0]) <= 1e-12 and j - i < top[2] - top[1]):
                    top = (total, i, j)
        return [] if top is None else [*best(a, top[1]), top, *best(top[2] + 1, b)]

    return best(0, len(scores))


def test_segments_against_the_definition():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randrange(0, 40)
        places = sorted(rng.sample(range(n), rng.randrange(0, n + 1))) if n else []
        weights = [rng.randrange(1, 64) / 16 + rng.random() / 1e4 for _ in places]
        drift = -rng.choice((0.125, 0.5, 1.0))
        scores = [drift] * n
        for p, w in zip(places, weights, strict=True):
            scores[p] = w
        got = toxic.segments(places, weights, drift)
        want = brute_segments(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert all(math.isclose(g[0], w[0], abs_tol=1e-9) for g, w in zip(got, want, strict=True))


def test_decay_is_the_root():
    weights, share = np.array([2.0, 5.0]), np.array([0.01, 0.001])
    rate = toxic.decay(weights, share, -0.3)
    assert math.isclose(float(share @ np.exp(rate * weights)) + (1 - share.sum()) * math.exp(-0.3 * rate), 1, rel_tol=1e-9)
    assert rate > 0


def test_tokens_are_runs_of_letters():
    texts = ["Ab1cD", "", "é-É ß", "  ", "x"]
    found = toxic.tokens(pa.array(texts))
    words = found.words.to_pylist()
    got = [words[c].decode() for c in found.code]
    assert got == ["ab", "cd", "é", "É", "ß", "x"] and found.counts.tolist() == [2, 0, 3, 0, 1]


def test_held_out_rows_and_strange_labels_teach_nothing(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("plain"), F.sha2(F.col("id").cast("string"), 256),
                                   F.when(F.col("id") % 3 == 0, "vile vile words")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    flipped = labels.withColumn("toxic", F.when(toxic.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    more = flipped.unionAll(spark.sql("SELECT cast(null AS bigint), 1 UNION ALL SELECT 1L, 7 UNION ALL SELECT 2L, null"))
    one, other = toxic.fit(docs, labels), toxic.fit(docs, more)
    assert one.words == other.words and b"vile" in one.words and b"plain" not in one.words
    assert (one.slope, one.offset, one.scale) == (other.slope, other.offset, other.scale)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1)], "doc_id bigint, toxic int")
    rows = awkward(spark)
    model = toxic.fit(rows, labels)
    got = toxic.score_documents(rows, model)
    assert got.count() == rows.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxic.score_documents(empty(spark), model).count() == 0
    nothing = toxic.fit(empty(spark), labels)
    assert {r.score for r in toxic.score_documents(rows, nothing).collect()} == {0.5}
    assert toxic.passages(empty(spark), model).count() == 0
