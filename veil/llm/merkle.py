"""A Merkle manifest of a table as a postorder append log, with a proof for every row.

Each row is a leaf; the rows of a group (the language) ascend by id and make a binary tree,
whose last run at a level may hold one node; the subroots, ordered by group, make one
more. Digests are lower-case hex SHA-256 and enter the next hash as text.

*Log.* Nodes are written in the order in which they become complete. When m leaves are in,
``2 m - popcount(m)`` nodes are; so leaf k stands at ``2 k - popcount(k)``, a complete node at
level l over the leaves from k on stands ``2 ** (l + 1) - 2`` further, and the nodes of the
ragged right edge follow all complete ones, bottom up (:func:`position`). Nothing about the
tree is stored but its number of leaves.

*Builders.* A task takes aligned blocks of ``2 ** BLOCK`` nodes, writes the block's segment of the
log, and hands on one node per block, which the next round takes as its input, until each
tree has one node. Rounds: one for every factor of ``2 ** BLOCK`` in the largest group. A block
is the most that a task holds, however large a group is.

*Proofs.* Extraction goes down the rounds: a builder's segment and the path of its block
give, by the positions of the siblings, the path of every input node. Segments and paths have
one row per block, so no key is hot.

Results: a null id comes first in its group and a null group before all others; equal ids
are ordered by their leaf, and equal rows get a leaf each. An empty table gives an empty
table. Very long texts are hashed as they stand; further columns count for nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veil.llm.common import delete, shared_folder

#: Levels of a block: a builder holds at most 2 ** BLOCK nodes and what is above them.
BLOCK = 9
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row in so many is altered by :func:`altered`.
TAMPERED = 7
#: Sides of a sibling; each element of a path is a side followed by the digest, if there is one.
LEFT, RIGHT, ALONE = "<", ">", "-"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its bytes in UTF-8, a colon, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def altered(doc_id: Column, n_chars: Column) -> Column:
    """The stated tampering: one more character where 7 divides the CRC-32 of the id."""
    hit = F.coalesce(F.crc32(doc_id.cast("string")) % TAMPERED == 0, F.lit(False))
    return F.when(hit, n_chars + 1).otherwise(n_chars)


# ------------------------------------------------------------- positions


def levels_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return (n - 1).bit_length()


def position(level: int, index: int, n: int) -> int:
    """Place in the log of a tree of ``n`` leaves of node ``index`` of a level."""
    first = index << level
    if (index + 1) << level <= n:
        return 2 * first - first.bit_count() + (2 << level) - 2
    # On the ragged edge; the lowest such level is the one above the last set bit of n.
    edge = (n & -n).bit_length() - 1
    return 2 * n - n.bit_count() + level - 1 - edge


def sibling(level: int, index: int, n: int) -> tuple[str, int]:
    """Side and index of the sibling of a node: left, right, or none where the node ends its level alone."""
    if index & 1:
        return LEFT, index - 1
    return (RIGHT, index + 1) if index + 1 < -(-n >> level) else (ALONE, -1)


# -------------------------------------------------------------- building


def build(nodes: list[str], first: int, base: int, n: int, bits: int = BLOCK) -> tuple[list[int], list[str], str]:
    """Log positions and digests of an aligned block in order of completion, and its top node.

    ``nodes`` are those of level ``base`` from ``first`` on; the nodes above them, up to
    the top of the block or the root, are made here.
    """
    rows = [(position(base, first + k, n), d) for k, d in enumerate(nodes)]
    for level in range(base + 1, min(base + bits, levels_of(n)) + 1):
        nodes, first = [digest(nodes[k : k + 2]) for k in range(0, len(nodes), 2)], first >> 1
        rows += [(position(level, first + k, n), d) for k, d in enumerate(nodes)]
    rows.sort()
    return [p for p, _ in rows], [d for _, d in rows], nodes[0]


def path_of(index: int, base: int, n: int, at: dict[int, str], bits: int = BLOCK) -> list[str]:
    """Siblings, bottom up, of an input node of a block whose nodes stand in ``at`` by position."""
    out = []
    for level in range(base, min(base + bits, levels_of(n))):
        side, other = sibling(level, index, n)
        out.append(side if side == ALONE else side + at[position(level, other, n)])
        index >>= 1
    return out


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for step in path:
        side, other = step[:1], step[1:]
        leaf = digest([other, leaf] if side == LEFT else [leaf, other])
    return leaf


def _ranked(rows: DataFrame, purpose: str) -> str:
    """Write ``rows`` (grp, key, node, at, …) with ``place`` in its group and the group's size ``n``.

    A range partitioning sorts all rows; ``at`` is unique, so equal rows are spread too. Sizes
    of the parts give the offsets, one small row for each part and group.
    """
    spark = rows.sparkSession
    order = [F.asc("grp"), F.asc_nulls_first("key"), F.asc("node"), F.asc("at")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    path = shared_folder(spark, f"{purpose}-sorted")
    sorted_.write.parquet(path)
    table = spark.read.schema(sorted_.schema).parquet(path)
    sizes = table.groupBy("grp", "part").agg(F.count("*").alias("size"), F.min("row").alias("first"))
    whole = Window.partitionBy("grp").orderBy("part")
    offsets = sizes.select(
        "grp", "part", (F.sum("size").over(whole) - F.col("size") - F.col("first")).alias("offset"),
        F.sum("size").over(Window.partitionBy("grp")).alias("n"))
    offsets_path = shared_folder(spark, f"{purpose}-offsets")
    offsets.write.parquet(offsets_path)
    out = shared_folder(spark, f"{purpose}-ranked")
    table.join(spark.read.schema(offsets.schema).parquet(offsets_path), ["grp", "part"]).withColumn(
        "place", F.col("row") + F.col("offset")).drop("row", "part", "offset", "at").write.parquet(out)
    delete(spark, path)
    delete(spark, offsets_path)
    return out


def _segments(rows: DataFrame, base: int, payload: list[str], bits: int) -> DataFrame:
    """One row per aligned block of ``rows`` (grp, place, n, node, payload …): its segment of the log.

    ``positions`` and ``digests`` stand in order of completion; ``node`` is what the block hands on,
    ``first`` its first place, and each payload column a list in the order of the places.
    """
    blocks = rows.withColumn("block", F.shiftright("place", bits))
    ordered = blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "place").select("grp", "block", "n", "place", "node", *payload)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in payload}
    schema = "grp string, block bigint, n bigint, positions binary, digests binary, node string" + "".join(f", {c} array<{k}>" for c, k in kinds.items())

    def finish(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows_ = pa.Table.from_batches(parts).combine_chunks()
        value = lambda c: rows_.column(c)[0]
        positions, digests, node = build(rows_.column("node").to_pylist(), value("place").as_py(), base, value("n").as_py(), bits)
        lists = []
        for c in payload:
            values = rows_.column(c).combine_chunks()
            lists.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
        return pa.RecordBatch.from_arrays(
            [pa.array([value(c).as_py()], t) for c, t in (("grp", pa.string()), ("block", pa.int64()), ("n", pa.int64()))]
            + [pa.array([np.array(positions, np.int64).tobytes()], pa.binary()), pa.array([bytes.fromhex("".join(digests))], pa.binary()), pa.array([node], pa.string()), *lists],
            names=["grp", "block", "n", "positions", "digests", "node", *payload])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            start = 0
            for k in range(len(keys)):
                if keys[k] != now:
                    if k > start:
                        held.append(batch.slice(start, k - start))
                    if held:
                        yield finish(held)
                    held, now, start = [], keys[k], k
            held.append(batch.slice(start))
        if held:
            yield finish(held)

    return ordered.mapInArrow(run, schema)


def _grown(ranked: DataFrame, purpose: str, payload: list[str], bits: int = BLOCK) -> tuple[list[str], DataFrame]:
    """Paths of the segment tables of all rounds, and ``grp``, ``subroot`` of every tree."""
    spark = ranked.sparkSession
    largest = ranked.agg(F.max("n")).first()[0] or 1
    tables: list[str] = []
    rows, roots = ranked, None
    for base in range(0, max(levels_of(largest), 1), bits):
        path = shared_folder(spark, f"{purpose}-{len(tables)}")
        _segments(rows, base, payload if not tables else [], bits).write.parquet(path)
        tables.append(path)
        segments = spark.read.parquet(path)
        done = F.col("n") <= 1 << (base + bits)
        top = segments.where(done).select("grp", F.col("node").alias("subroot"))
        roots = top if roots is None else roots.unionAll(top)
        rows = segments.where(~done).select("grp", F.col("block").alias("place"), "n", "node")
    return tables, roots


def log(spark: SparkSession, tables: list[str], bits: int = BLOCK) -> DataFrame:
    """The log as rows: ``grp``, ``position``, ``digest``; inputs of a later round are in the one before."""
    def run(base: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for grp, block, n, places, digests in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    first = block << bits
                    given = {position(base, k, n) for k in range(first, min(first + (1 << bits), -(-n >> base)))} if base else set()
                    raw = digests.hex()
                    rows = [(p, raw[64 * i : 64 * i + 64]) for i, p in enumerate(np.frombuffer(places, np.int64).tolist()) if p not in given]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([grp] * len(rows), pa.string()), pa.array([p for p, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.string())],
                        names=["grp", "position", "digest"])
        return work

    parts = [spark.read.parquet(t).select("grp", "block", "n", "positions", "digests").mapInArrow(run(r * bits), "grp string, position bigint, digest string")
             for r, t in enumerate(tables)]
    return reduce(DataFrame.unionAll, parts)


def _extract(spark: SparkSession, tables: list[str], above: DataFrame, payload: list[str], last: Callable, schema: str, bits: int) -> DataFrame:
    """Go down the rounds with the path of every tree (``above``: grp, subroot, path).

    ``last`` makes the rows of a block of leaves from its places, leaves, paths, subroot and
    payload; ``schema`` is theirs.
    """
    waiting = None
    for r in reversed(range(len(tables))):
        base = r * bits
        segments = spark.read.parquet(tables[r])
        tops = segments.where((F.col("n") <= 1 << (base + bits)) & (F.lit(r == 0) | (F.col("n") > 1 << base))).select("grp", "block").join(above, "grp")
        paths = tops if waiting is None else tops.unionByName(waiting)
        met = segments.drop("node").join(paths, ["grp", "block"])
        waiting = met.mapInArrow(_downward(base, payload if r == 0 else [], last if r == 0 else None, bits), schema if r == 0 else PATHS)
        if r:
            path = shared_folder(spark, "merkle-paths")
            waiting.write.parquet(path)
            waiting = spark.read.parquet(path)
    return waiting


PATHS = "grp string, block bigint, subroot string, path array<string>"


def _downward(base: int, payload: list[str], last: Callable | None, bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                value = lambda c: batch.column(batch.schema.get_field_index(c))[k]  # noqa: E731, B023
                n, block = value("n").as_py(), value("block").as_py()
                places = np.frombuffer(value("positions").as_py(), np.int64).tolist()
                raw = value("digests").as_py().hex()
                at = {p: raw[64 * i : 64 * i + 64] for i, p in enumerate(places)}
                first = block << bits
                size = min(1 << bits, -(-n >> base) - first)
                upper, subroot = value("path").as_py(), value("subroot").as_py()
                paths = [path_of(first + i, base, n, at, bits) + upper for i in range(size)]
                if last is None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([value("grp").as_py()] * size, pa.string()), pa.array(range(first, first + size), pa.int64()),
                         pa.array([subroot] * size, pa.string()), pa.array(paths, pa.list_(pa.string()))],
                        names=["grp", "block", "subroot", "path"])
                else:
                    leaves = [at[position(0, first + i, n)] for i in range(size)]
                    yield last(leaves, paths, subroot, {c: value(c).values for c in payload})

    return run


# -------------------------------------------------------------- manifest


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", size_col: str = "n_chars", bits: int = BLOCK) -> DataFrame:
    """Every row with its leaf, the roots, and its proof checked against a tampered row.

    ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (hash of the siblings, bottom up),
    ``folded_root`` (from the leaf as :func:`altered` leaves it), ``verified``, and ``path``, the
    siblings with their sides.
    """
    spark = docs.sparkSession
    leaf = leaf_digest(*(F.col(c) for c in fields))
    changed = altered(F.col(id_col), F.col(size_col))
    other = leaf_digest(*(changed if c == size_col else F.col(c) for c in fields))
    hit = ~changed.eqNullSafe(F.col(size_col))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
        F.col(id_col).alias("key"), leaf.alias("node"), F.when(hit, other).alias("tampered"),
        F.monotonically_increasing_id().alias("at"))
    path = shared_folder(spark, "merkle-leaves")
    rows.write.parquet(path)
    ranked = _ranked(spark.read.schema(rows.schema).parquet(path), "merkle")
    delete(spark, path)
    payload = ["key", "tampered"]
    tables, roots = _grown(spark.read.parquet(ranked), "merkle-log", payload, bits)
    # The subroots make one more tree, by the same steps.
    tops = _ranked(roots.select(
        F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("subroot").alias("node"), F.lit(0).cast("bigint").alias("at")), "merkle-roots")
    upper, root = _grown(spark.read.parquet(tops), "merkle-top", ["key"], bits)
    whole = root.first()
    root_digest = whole["subroot"] if whole else None

    def subroots(leaves: list[str], paths: list[list[str]], _: str, given: dict[str, pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given["key"], pa.array(leaves), pa.array(paths, pa.list_(pa.string()))], names=["grp", "subroot", "path"])

    none = spark.createDataFrame([("", "", [])], PATHS.replace(", block bigint", ""))
    above = _extract(spark, upper, none, ["key"], subroots, "grp string, subroot string, path array<string>", bits)

    def proofs(leaves: list[str], paths: list[list[str]], subroot: str, given: dict[str, pa.Array]) -> pa.RecordBatch:
        folded = [fold(t or leaf, p) for leaf, t, p in zip(leaves, given["tampered"].to_pylist(), paths, strict=True)]
        return pa.RecordBatch.from_arrays(
            [given["key"], pa.array(leaves), pa.array([subroot] * len(leaves)), pa.array([root_digest] * len(leaves), pa.string()),
             pa.array([digest([s[1:] for s in p]) for p in paths]), pa.array(folded), pa.array([f == root_digest for f in folded]),
             pa.array(paths, pa.list_(pa.string()))],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "path"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _extract(
        spark, tables, above, payload, proofs,
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, path array<string>", bits)
