"""Embedding near-dedup by cross-polytope hashing.

Vectors are turned to unit length in double precision and rotated by three rounds of
random signs and a fast Hadamard transform. The hash is the axis of the largest
coordinate, with its sign; ``K`` of them are one bucket of a table. A vector lies in its
own bucket of each of at least ``TABLES`` tables and also probes the ``PROBES - 1`` buckets
that are next likely: those that swap the least certain axes for their second or third
choice. Every candidate is verified by its cosine.

Equal vectors are one class from the start, so a vector that a third of all rows share
is hashed once. A pair that several buckets bring together is counted in the first of
them only; a bucket returns link counts and a spanning set of links, never its pairs.
A bucket above ``BLOCK`` vectors is divided into blocks of its own vectors, and all that
probe it are held against each block: memory stays bounded and no partner is lost.

``K`` grows with the number of vectors, so that buckets keep their size, and the tables with
``K``, so that a pair at the least cosine meets with probability ``MEET`` at any size.

Results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing (n_links 0, their own id as component). Vectors of different length never
link. Null ids take part but are never a component's id unless it has no other. Recall
against brute force is measured in the tests (over 0.98 at cosine 0.9).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import stored
from veil.llm.components import components

#: Tables at least, buckets of a vector in each; probability that a pair at the least cosine meets.
TABLES, PROBES, MEET = 6, 6, 0.985
#: Vectors a bucket should hold on average at most; sets the number of hashes.
PER_BUCKET = 16
#: Own vectors of a bucket that one task holds at once.
BLOCK = 4096
SEED = 20
COSINE = 0.9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def rotations(dim: int, count: int) -> np.ndarray:
    """Random signs for ``count`` rotations of three rounds each."""
    width = 1 << max(1, (dim - 1).bit_length())
    return np.random.default_rng(SEED + dim).choice([-1.0, 1.0], size=(count, 3, width))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at unit length; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def hash_codes(x: np.ndarray, signs: np.ndarray, k: int, probes: int = PROBES) -> np.ndarray:
    """Buckets (rows, tables, probes) of unit vectors; the first probe is the own bucket."""
    n, dim = x.shape
    width = signs.shape[2]
    tables = len(signs) // k
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    options = min(3, width)
    choice = np.empty((n, tables, k, options), np.int64)
    cost = np.empty((n, tables, k, options))
    for r in range(tables * k):
        y = padded
        for s in signs[r]:
            y = hadamard(y * s)
        size = np.abs(y)
        top = np.argsort(-size, axis=1, kind="stable")[:, :options]
        choice[:, r // k, r % k] = top * 2 + (np.take_along_axis(y, top, 1) < 0)
        best = np.take_along_axis(size, top, 1)
        cost[:, r // k, r % k] = best[:, :1] - best
    base = 2 * width
    weight = base ** np.arange(k, dtype=np.int64)
    # Change one or two hashes to another choice; keep the cheapest changes.
    swaps = [()] + [((j, o),) for j in range(k) for o in range(1, options)]
    swaps += [(a, b) for a, b in itertools.combinations([s[0] for s in swaps[1:]], 2) if a[0] != b[0]]
    own = (choice[..., 0] * weight).sum(-1)
    codes = np.stack([own + sum((choice[:, :, j, o] - choice[:, :, j, 0]) * weight[j] for j, o in s) for s in swaps], -1)
    price = np.stack([np.zeros_like(own, float) + sum(cost[:, :, j, o] for j, o in s) for s in swaps], -1)
    price[..., 0] = -1
    order = np.argsort(price, axis=-1, kind="stable")[..., :probes]
    return np.take_along_axis(codes, order, -1)


def hashes_for(vectors: int, dim: int) -> int:
    """Hashes per bucket so that buckets hold about ``PER_BUCKET`` vectors."""
    base = 2 * (1 << max(1, (dim - 1).bit_length()))
    return max(1, min(round(math.log(max(2, vectors / PER_BUCKET), base)), int(62 // math.log2(base))))


def pairs_at(least: float, dim: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors at this cosine."""
    rng = np.random.default_rng(seed)
    x, z = unit(rng.normal(size=(count, dim))), rng.normal(size=(count, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, least * x + math.sqrt(max(0.0, 1 - least * least)) * z


@functools.cache
def tables_for(k: int, dim: int, least: float = COSINE) -> int:
    """Tables in which a pair at ``least`` meets with probability ``MEET``, from 2,000 random pairs."""
    if dim < 2:
        return TABLES
    signs = rotations(dim, TABLES * k)
    a, b = (hash_codes(x, signs, k) for x in pairs_at(least, dim, 2000, SEED))
    met = ((a[:, :, :1] == b).any(-1) | (b[:, :, :1] == a).any(-1)).mean()
    met = min(max(float(met), 1e-3), 1 - 1e-9)
    return max(TABLES, math.ceil(math.log(1 - MEET) / math.log(1 - met)))


def _codes(classes: DataFrame, k_of: dict[int, int], tables_of: dict[int, int]) -> DataFrame:
    """Add ``codes``, all buckets of a class, flattened by table and probe, and the number of ``tables``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                values, ends = _lists(part.column(2))
                sizes = np.diff(ends)
                codes: list = [None] * part.num_rows
                for dim in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dim)
                    x = unit(values[(ends[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim).astype(float))
                    k = k_of[int(dim)]
                    got = hash_codes(x, rotations(int(dim), tables_of[int(dim)] * k), k).reshape(len(rows), -1)
                    for r, c in zip(rows, got, strict=True):
                        codes[r] = c
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(codes, pa.list_(pa.int64())), pa.array([tables_of[int(d)] for d in sizes], pa.int32())],
                    names=[*part.schema.names, "codes", "tables"])

    kind = classes.schema["v"].dataType.simpleString()
    return classes.mapInArrow(run, f"c bigint, n bigint, v {kind}, codes array<bigint>, tables int")


#: ids, weights, unit vectors and codes of some rows.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
#: Rows that are held against a block at once.
AT_ONCE = 1024


class _Bucket:
    """The block of own vectors of one bucket, against which members and probes are held."""

    def __init__(self, table: int, least: float):
        self.table, self.least = table, least
        self.parts: list[Rows] = []

    def own(self) -> Rows:
        if len(self.parts) > 1:
            self.parts = [tuple(np.concatenate(x) for x in zip(*self.parts, strict=True))]
        return self.parts[0]

    def meet(self, rows: Rows | None, out: list[tuple]) -> None:
        """Links of the block with further rows; ``None`` stands for the block itself."""
        ids, weight, x, codes = self.own()
        others = self.own() if rows is None else rows
        for at in range(0, len(others[0]), AT_ONCE):
            ids2, weight2, y, codes2 = (z[at : at + AT_ONCE] for z in others)
            i, j = np.nonzero(x @ y.T >= self.least)
            # Own vectors meet once, as pairs in order of id.
            keep = ids[i] < ids2[j] if rows is None else ids[i] != ids2[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            # Only the first table, and in it the bucket of the lower id, counts a pair.
            p, q = codes[i], codes2[j]
            at_first = (p[:, :, :1] == q).any(-1) | (q[:, :, :1] == p).any(-1)
            keep = ~at_first[:, : self.table].any(1)
            back = (q[:, self.table, :1] == p[:, self.table]).any(-1)  # found from the other side as well
            keep &= (ids[i] < ids2[j]) | ~back
            i, j = i[keep], j[keep]
            if len(i):
                self.count(ids, weight, ids2, weight2, i, j, out)

    def count(self, ids, weight, ids2, weight2, i, j, out) -> None:
        for mine, theirs, k, m in ((ids, weight2, i, j), (ids2, weight, j, i)):
            total = np.bincount(k, weights=theirs[m], minlength=len(mine))
            out += [(int(mine[r]), None, int(total[r])) for r in np.flatnonzero(total)]
        # A spanning set of the links.
        root: dict[int, int] = {}

        def find(a: int) -> int:
            while root.setdefault(a, a) != a:
                root[a] = root[root[a]]
                a = root[a]
            return a

        for a, b in zip(ids[i].tolist(), ids2[j].tolist(), strict=True):
            u, v = find(a), find(b)
            if u != v:
                root[max(u, v)] = min(u, v)
                out.append((a, b, 0))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False), offsets - offsets[0]


def _links(coded: DataFrame, tables_of: dict[int, int], least: float, block: int) -> DataFrame:
    """(a, null, n): n links of class a; (a, b, 0): one link of a spanning set."""
    kind = coded.schema["v"].dataType.simpleString()
    probes = (F.size("codes") / F.col("tables")).cast("int")
    probe = coded.select("c", "n", "v", "codes", F.size("v").alias("dim"), F.posexplode(F.transform(
        F.sequence(F.lit(0), F.col("tables") - 1), lambda t: F.array_distinct(F.slice("codes", t * probes + 1, probes))
    )).alias("t", "buckets"))
    crowded = stored(
        probe.groupBy("dim", "t", F.element_at("buckets", 1).alias("bucket")).agg(F.count("*").alias("own"))
        .where(F.col("own") > block).select("dim", "t", "bucket", F.ceil(F.col("own") / block).cast("int").alias("blocks")), "crowded-buckets")
    rows = probe.select("c", "n", "v", "codes", "dim", "t", F.posexplode("buckets").alias("pos", "bucket"))
    rows = rows.join(crowded, ["dim", "t", "bucket"], "left") if not crowded.isEmpty() else rows.withColumn("blocks", F.lit(1))
    blocks = F.coalesce("blocks", F.lit(1))
    home = F.pmod(F.xxhash64("c"), blocks).cast("int")
    placed = rows.withColumn("s", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn(
        "role", F.when((F.col("pos") == 0) & (F.col("s") == home), 0).otherwise(1)
    ).select("t", "dim", "bucket", "s", "role", "c", "n", "v", "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bucket, out = None, None, []

        def close() -> None:
            if bucket is not None and bucket.parts and (len(bucket.parts) > 1 or len(bucket.parts[0][0]) > 1):
                bucket.meet(None, out)

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)], axis=1)
            ids, weight = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            values, ends = _lists(batch.column(7))
            codes, code_ends = _lists(batch.column(8))
            edges = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                *now, role = keys[i].tolist()
                if now != key:
                    close()
                    key, bucket = now, _Bucket(now[0], least)
                if role and not bucket.parts:
                    continue
                x = unit(values[ends[i] : ends[j]].reshape(j - i, -1).astype(float))
                rows = (ids[i:j], weight[i:j], x, codes[code_ends[i] : code_ends[j]].reshape(j - i, tables_of[now[1]], -1))
                if role:
                    bucket.meet(rows, out)
                else:
                    bucket.parts.append(rows)
            if out:
                yield as_batch(out)
                out.clear()
        close()
        if out:
            yield as_batch(out)

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        a, b, n = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    owned = placed.repartition("t", "dim", "bucket", "s").sortWithinPartitions("t", "dim", "bucket", "s", "role")
    assert kind.startswith("array")
    return owned.mapInArrow(run, "a bigint, b bigint, n bigint")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    sound = (
        F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = stored(
        rows.where("sound").groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"))
        .withColumn("c", F.monotonically_increasing_id()), "vector-classes")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    k_of = {dim: hashes_for(n, dim) for dim, n in sizes.items()}
    tables_of = {dim: tables_for(k, dim, least) for dim, k in k_of.items()}
    found = stored(_links(_codes(classes.select("c", "n", "v"), k_of, tables_of), tables_of, least, block), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "c")
    named = classes.select("c", "v", "n", "least_id").join(counts, "c", "left").join(roots, "c", "left").select(
        "v", "least_id", F.coalesce("root", "c").alias("root"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    firsts = named.groupBy("root").agg(F.min("least_id").alias("first_id"))
    of_class = named.join(firsts, "root").select("v", "links", "first_id")
    good = rows.where("sound").join(of_class, "v").select(
        "vec_id", F.col("links").alias("n_links"), F.col("first_id").alias("component_id"))
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
