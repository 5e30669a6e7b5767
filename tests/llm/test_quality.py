import binascii

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from veil.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = quality.score_documents(docs, model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 40 and all(binascii.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep_documents(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == quality.score_documents(docs, model).where("predicted = 1").count()


def test_training_uses_at_most_the_rows_asked_for_and_no_held_out_row(spark, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows: seen.append(rows))
    quality.fit(docs, labels, rows=50)
    quality.fit(docs, labels)
    assert len(seen[0]) == 50
    assert len(seen[1]) == sum(binascii.crc32(str(k).encode()) % 5 != 0 for k in range(400))


def test_scores_are_the_mean_of_units():
    rng = np.random.default_rng(1)
    weight = rng.normal(size=quality.BUCKETS).astype(np.float32)
    texts = ["one two two three", "", "  \n", "é", "two two two", "one\ttwo\ntwo  three"]
    got = quality.scores(pa.array(texts), weight, 0.25)
    for text, score, (ids, part) in zip(texts, got, quality.hashed_units(pa.array(texts)), strict=True):
        assert np.isclose(score, 1 / (1 + np.exp(-(0.25 + (weight[ids].astype(float) * part).sum()))), atol=1e-5), text
    assert got[0] == got[5]  # white space of any kind
    assert np.isclose(quality.scores(pa.array(texts[:1]), weight, 0.25)[0], got[0])  # whatever else is in the batch


def test_a_repeated_word_is_a_back_reference():
    (ids, weight), = quality.hashed_units(pa.array(["ab ab cd cd"]))
    assert quality.BACK in ids and np.isclose(weight[ids == quality.BACK][0], 2 / 3)
    (ids, _), = quality.hashed_units(pa.array(["ab cd ab cd"]))
    assert quality.BACK not in ids


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 0), (None, 1), (77, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == docs.count()
    none = {r.score for r in rows if r.doc_id in (2, 3)}
    assert len(none) == 1  # the bias
    untrained = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score_documents(docs, untrained).collect()} == {0.5}
    assert quality.score_documents(empty(spark), model).count() == 0
    assert quality.keep_documents(empty(spark), model).count() == 0
    assert not spark.range(1).select(quality.held_out(F.lit(None).cast("bigint")).alias("x")).first().x


def test_what_training_gathers_is_bounded_in_bytes(spark, monkeypatch):
    """An id on a third of the rows is one training row, and a text of any length gives so many units."""
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows: seen.append(rows))
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") == 7, F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda k: F.sha2(k.cast("string"), 256))))
        .otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    quality.fit(docs, labels.where("doc_id IN (2, 7)"))
    assert len(seen[0]) == 2
    assert max(len(ids) for _, ids, _ in seen[0]) == quality.TRAIN_UNITS
    assert all(abs(weight.sum() - 2) < 1e-3 for _, ids, weight in seen[0] if len(ids) == quality.TRAIN_UNITS)
