from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from veil.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for doc, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc, keep, len(ids), doc == keep, sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    docs = awkward(spark, [(100 + k, f"text {k % 7}") for k in range(300)] + [(900 + k, "hot") for k in range(200)])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = exact.exact_groups(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert exact.exact_groups(empty(spark)).count() == 0


def test_directory_splits_overfull_buckets_only(spark):
    # 64 keys that agree in their first 20 bits, and 4 elsewhere.
    near = [(5 << 44) + (k << 38) for k in range(64)]
    keys = spark.createDataFrame([(k,) for k in [*near, 1 << 62, -1, -(1 << 62), 3 << 60]], "h bigint")
    buckets = exact.directory(keys, bucket_keys=8, entries=1 << 16)
    starts = [s for s, _ in buckets]
    assert starts == sorted(starts) and starts[0] == 0
    ends = [*starts[1:], 1 << 64]
    assert all(e - s == 1 << (64 - depth) for (s, depth), e in zip(buckets, ends, strict=True))
    unsigned = [k % (1 << 64) for k in [*near, 1 << 62, -1, -(1 << 62), 3 << 60]]
    assert max(sum(s <= k < e for k in unsigned) for s, e in zip(starts, ends, strict=True)) <= 8
    assert len({depth for _, depth in buckets}) > 2


def test_one_key_is_never_split(spark):
    keys = spark.createDataFrame([(7,)], "h bigint")
    assert exact.directory(keys, bucket_keys=1) == [(0, 0)]


def test_chains_compare_bytes():
    links = exact._chain([(b"a", 1, 2), (b"b", 9, 1), (b"a", 5, 1), (b"b", None, 1)])
    assert links == [[b"a", 5, 3], [b"b", 9, 2]]


def test_small_buckets_give_the_same(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 700).alias("text"))
    index = exact.build_index(docs, bucket_keys=4)
    assert index.count() == 700 and index.agg(F.sum("group_size")).first()[0] == 2000
    assert index.select("bucket").distinct().count() > 200
