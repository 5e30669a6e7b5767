"""SimHash near-dedup with BK-trees over shards of the fingerprints.

A fingerprint has a bit for the majority of the hashes of all word shingles of a whole
text. Fingerprints link at ``radius`` (2) or fewer differing bits. Only distinct
fingerprints are compared, so copies cost nothing.

The 64 bits are cut into four blocks. Two fingerprints with at most two differing bits
agree in at least two blocks, so each fingerprint goes to six shards, one for each pair
of blocks and their value. The task that owns a shard gets its tree: children hang on
their integer Hamming distance to the parent, and a search follows only the edges whose
distance is within the radius of its own. A shard above ``SHARD`` members is not searched
as a whole: its members pass on to shards that agree in two quarters of the bits that
are still free, until at most 256 members can be left. This loses no link. A
shard returns a spanning set of its links, never all pairs.

``similar_groups`` and ``keep_one`` link by similarity instead: five words, and 256 bits, at
which a Jaccard similarity of 0.8 is a mean distance of 38; candidates are pairs up to 54, two and a
half spreads more. That is beyond any exact blocking, so shards are the values of randomly
chosen bits, in as many tables as a pair at that radius needs to meet with probability ``MEET``; the number of bits grows with
the logarithm of the fingerprints, so shards keep their size. Prints give candidates only, from
distinct shingles; a link is a pair whose shingle sets have the similarity, computed exactly.
Two rounds test the nearest and the least candidate of each class of equal sets; a last one tests
all candidates that are still in different groups. From the second round on, classes that have a
candidate at all carry a parity sketch of their shingles too: a bit is the parity of the shingles
that fall on it, so two sketches differ in as many bits as the sets differ in shingles, collisions
aside. Candidates whose sketches rule the similarity out are not handed on, so that a group of
texts that are all near each other, but not near enough, does not leave its task pair by pair.

Results: a null text counts as empty; texts without words have fingerprint zero and link
like any other. Rows may repeat. ``component_id`` is the least id that links reach,
nulls aside (null if a component has null ids only). An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import keyed_text, map_arrow, spare_name, stored
from veil.llm.components import components

WORDS, RADIUS, SEED = 3, 2, 42
#: Words and Jaccard similarity of groups of similar documents, and 64-bit lanes of their prints.
SIMILAR_WORDS, SIMILARITY, LANES = 5, 0.8, 4
#: Fingerprints of a shard on average; probability that a pair at the radius meets; spreads of the
#: distance between its mean and the radius.
PER_SHARD, MEET, TAIL = 16, 0.97, 2.5
#: Bits of a parity sketch; spreads above the mean up to which a pair of sketches passes.
SKETCH, SKETCH_TAIL = 1024, 4.0
#: Members up to which a shard is searched as one tree.
SHARD = 2048
BLOCKS = 4


def _shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every word shingle, A-Z in lower case, white space in between; one for a short text."""
    parts = text.lower().split()  # on bytes: ASCII letters and \x20, \x09-\x0d only
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[k:] for k in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], np.uint64)


def _majority(hashes: np.ndarray) -> bytes:
    """Eight bytes, little-endian: a bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[k : k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes()


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint; 0 for a text without words."""
    return int.from_bytes(_majority(_shingle_hashes(text, words)), "little")


def wide_fingerprint(text: bytes, words: int = SIMILAR_WORDS) -> bytes:
    """A fingerprint of ``LANES`` * 64 bits, from as many mixtures of each distinct shingle's hash."""
    return _wide_print(shingle_set(text, words))


def shingle_set(text: bytes, words: int = SIMILAR_WORDS) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    return np.unique(_shingle_hashes(text, words))


def _wide_print(hashes: np.ndarray) -> bytes:
    out = []
    for lane in range(LANES):
        h = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(_majority(h ^ (h >> np.uint64(31))))
    return b"".join(out)


def parity_sketch(hashes: np.ndarray) -> bytes:
    """``SKETCH`` bits: the parity of the number of distinct shingles that fall on each."""
    return np.packbits(np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH).astype(np.uint8) & 1, bitorder="little").tobytes()


def sketch_bound(shingles: np.ndarray, similarity: float) -> np.ndarray:
    """Differing bits up to which sketches of sets with so many shingles together may have the similarity.

    Never below the shingles in which such sets can differ, unless that is more than ``SKETCH_TAIL``
    spreads above the mean that collisions leave of them.
    """
    apart = shingles * ((1 - similarity) / (1 + similarity)) + 1e-6
    share = (1 - (1 - 2 / SKETCH) ** apart) / 2
    return np.minimum(apart, SKETCH * share + SKETCH_TAIL * np.sqrt(SKETCH * share * (1 - share)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t.encode(), words) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"]
        )

    texts = keyed_text(docs, id_col, text_col)
    return map_arrow(texts, work, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fp bigint")


class BKTree:
    """Children of a node by their distance to it; ``add`` returns what lies within the radius."""

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> list[int]:
        """Insert a value; the indexes of earlier ones within the radius."""
        near: list[int] = []
        values, children, r = self.values, self.children, self.radius
        if values:
            todo = [0]
            while todo:
                i = todo.pop()
                d = (values[i] ^ value).bit_count()
                if d <= r:
                    near.append(i)
                below = children[i]
                if below:
                    todo += [c for e, c in below.items() if d - r <= e <= d + r]
            at = 0
            while True:
                d = (values[at] ^ value).bit_count()
                step = children[at].get(d)
                if step is None:
                    children[at][d] = len(values)
                    break
                at = step
        values.append(value)
        children.append({})
        return near


def _spanning(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join the same members as all links of the shard do."""
    tree, root = BKTree(radius), list(range(len(members)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for k, value in enumerate(members):
        for i in tree.add(value):
            a, b = find(i), find(k)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((members[i], value))
    return out


def _shards(points: DataFrame, level: int) -> DataFrame:
    """Rows (shard, fp) for every choice of two agreeing blocks of the free bits.

    ``points`` has ``fp`` and ``free``, the 64-bit mask of bits that may still differ.
    """
    width = 16 >> level  # of 64, 32 and 16 free bits; 32, 16 and 8 stay free

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column(0).to_numpy().view(np.uint64)
        free = batch.column(1).to_numpy().view(np.uint64)
        out_fp, out_free = [], []
        for mask in np.unique(free):
            at = fp[free == mask]
            bits = [k for k in range(64) if int(mask) >> k & 1]
            for pair in itertools.combinations(range(BLOCKS), BLOCKS - RADIUS):
                fixed = sum(1 << b for p in pair for b in bits[p * width : (p + 1) * width])
                out_fp.append(at)
                out_free.append(np.full(len(at), int(mask) & ~fixed, np.uint64))
        fps, frees = np.concatenate(out_fp), np.concatenate(out_free)
        return pa.RecordBatch.from_arrays(
            [pa.array(frees.view(np.int64)), pa.array((fps & ~frees).view(np.int64)), pa.array(fps.view(np.int64))],
            names=["free", "fixed", "fp"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                yield work(batch.slice(k, 4096))

    return points.mapInArrow(run, "free bigint, fixed bigint, fp bigint")


def _search(shards: DataFrame, radius: int, limit: int) -> DataFrame:
    """(a, b, free): links of the shards; or, with null b, members of shards above ``limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, passing = None, [], False
        a: list[int] = []
        b: list[int | None] = []
        free: list[int] = []

        def close() -> None:
            if not passing and len(held) > 1:
                # Distances are of unsigned numbers: Python counts the bits of an absolute value.
                signed = {x % (1 << 64): x for x in held}
                for x, y in _spanning(list(signed), radius):
                    a.append(signed[x]), b.append(signed[y]), free.append(0)
            held.clear()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(free, pa.int64())], names=["a", "b", "free"])
            a.clear(), b.clear(), free.clear()
            return out

        for batch in batches:
            mask, fixed, fps = (batch.column(i).to_pylist() for i in range(3))
            for m, f, x in zip(mask, fixed, fps, strict=True):
                if (m, f) != key:
                    close()
                    key, passing = (m, f), False
                held.append(x)
                if len(held) > limit or passing:
                    passing = True
                    a.extend(held), b.extend([None] * len(held)), free.extend([m] * len(held))
                    held.clear()
            if a:
                yield flush()
        close()
        if a:
            yield flush()

    owned = shards.repartition("free", "fixed").sortWithinPartitions("free", "fixed", "fp")
    return owned.mapInArrow(run, "a bigint, b bigint, free bigint")


def near_links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect the same distinct ``fp`` as all links within the radius do."""
    if radius > RADIUS:
        raise ValueError("shards agree in two of four blocks: a radius of at most 2 is searched without loss")
    spark = fps.sparkSession
    points = fps.select("fp", F.lit(-1).cast("bigint").alias("free"))
    links = None
    for level in range(3):
        last = level == 2
        found = stored(_search(_shards(points, level), radius, 1 << 30 if last else shard), "simhash-links")
        new = found.where("b is not null").select("a", "b")
        links = new if links is None else links.unionAll(new)
        over = found.where("b is null").select(F.col("a").alias("fp"), "free").distinct()
        if last or over.isEmpty():
            break
        points = over
    return links


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    prints = stored(fingerprints(docs, id_col, text_col, words), "simhash-docs")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    labels = components(near_links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = nodes.join(labels, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    firsts = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(firsts, "root").select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def distance_of(similarity: float) -> int:
    """Differing bits, of 64 * LANES, that a Jaccard similarity stands for."""
    return int(64 * LANES * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def radius_of(similarity: float) -> int:
    """Differing bits up to which pairs are candidates: ``TAIL`` spreads above the mean distance."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(64 * LANES * share + TAIL * math.sqrt(64 * LANES * share * (1 - share)))


def sampled_bits(prints: int, radius: int) -> np.ndarray:
    """Bits (table, place) that the shards of so many fingerprints are made of."""
    width = min(48, max(8, math.ceil(math.log2(max(2, prints / PER_SHARD)))))
    tables = math.ceil(math.log(1 / (1 - MEET)) / (1 - radius / (64 * LANES)) ** width)
    rng = np.random.default_rng(6)
    return np.stack([rng.choice(64 * LANES, width, replace=False) for _ in range(tables)])


def _large_shard(values: list[bytes], radius: int) -> list[tuple[int, int]]:
    """Spanning links (by place) of a shard of any size, without comparing members of one component twice."""
    x = np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1)
    label = np.full(len(x), -1)
    out: list[tuple[int, int]] = []

    def link(i: int) -> None:
        near = np.flatnonzero(np.bitwise_count(x ^ x[i]).sum(1) <= radius)
        found = np.unique(label[near])
        label[near[label[near] < 0]] = i
        if label[i] < 0:
            label[i] = i
        out.extend((i, int(k)) for k in near[label[near] == i] if k != i)
        for other in found[(found >= 0) & (found != label[i])]:
            out.append((i, int(near[label[near] == other][0])))
            label[label == other] = label[i]

    for i in range(len(x)):
        if label[i] < 0:
            link(i)
    names, sizes = np.unique(label, return_counts=True)
    for i in np.flatnonzero(label != names[sizes.argmax()]):
        link(int(i))
    return out


def _cross(node: np.ndarray, label: np.ndarray, size: np.ndarray, x: np.ndarray, radius: int, least: float) -> Iterator[tuple]:
    """Chunks (rows, ok, d, inside): members of a shard against all its members of another label.

    ``x`` has the prints, and after them the parity sketches, if there are any; ``d`` is the distance by
    the sketch then.
    """
    x, odd = x[:, :LANES], x[:, LANES:]
    names, at, counts = np.unique(label, return_inverse=True, return_counts=True)
    rest = np.flatnonzero(at != counts.argmax())
    inside = np.zeros(len(x), bool)
    inside[rest] = True
    step = max(1, (1 << 20) // len(x))
    for k in range(0, len(rest), step):
        rows = rest[k : k + step]
        d = np.bitwise_count(x[rows][:, None] ^ x[None]).sum(2, dtype=np.int32)
        ok = (d <= radius) & (label[rows][:, None] != label[None])
        ok &= np.minimum(size[rows][:, None], size[None]) >= least * np.maximum(size[rows][:, None], size[None]) - 1e-6
        if odd.shape[1]:
            i, j = np.nonzero(ok)
            for at in range(0, len(i), 1 << 15):
                p, q = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
                apart = np.bitwise_count(odd[rows[p]] ^ odd[q]).sum(1, dtype=np.int32)
                d[p, q] = apart
                ok[p, q] = apart <= sketch_bound(size[rows[p]] + size[q], least)
        yield rows, ok, d, inside


def similar_candidates(nodes: DataFrame, radius: int, bits: np.ndarray, least: float, every: bool) -> DataFrame:
    """Pairs (a, b) of nodes of different ``label`` that share a shard, within ``radius`` bits.

    ``nodes`` has ``node``, ``label``, ``size`` (of the shingle set) and ``fp``, the print with or without the
    parity sketch behind it, alike in all rows. With ``every`` all such
    pairs, each once; else the nearest and the least partner of a node in each shard, or a spanning
    set of a shard above ``SHARD`` members. Pairs whose sizes or sketches rule out a similarity
    of ``least`` are left out.
    """
    power = 1 << np.arange(bits.shape[1], dtype=np.int64)
    spread = np.zeros((len(bits), 64 * LANES), np.uint8)
    np.put_along_axis(spread, bits, 1, axis=1)
    masks = np.packbits(spread, axis=1, bitorder="little").view(np.uint64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                raw = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(part.num_rows, -1)[:, : 8 * LANES]
                spread = np.unpackbits(raw, axis=1, bitorder="little")
                keys = np.concatenate([spread[:, b] @ power for b in bits])
                index = pa.array(np.tile(np.arange(part.num_rows), len(bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(len(bits), dtype=np.int32), part.num_rows)), pa.array(keys), *(c.take(index) for c in part.columns)],
                    names=["t", "key", "node", "label", "size", "fp"])

    def first_met(t: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Which pairs of prints share a shard in no table before ``t``."""
        apart, left, at = p ^ q, np.arange(len(p)), 0
        while at < t and len(left):
            some = masks[at : min(t, at + max(1, (1 << 13) // len(left)))]
            left = left[((apart[left][:, None] & some[None]) != 0).any(2).all(1)]
            at += len(some)
        new = np.zeros(len(p), bool)
        new[left] = True
        return new

    def shard(t: int, parts: list[tuple]) -> Iterator[tuple]:
        node, label, size, x = (np.concatenate(c) for c in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]
        if len(node) < 2 or (label == label[0]).all():
            return
        if not every and len(node) > SHARD and len(np.unique(label)) == len(label):
            x = np.ascontiguousarray(x[:, :LANES])
            links = np.array(_large_shard([v.tobytes() for v in x], radius), np.int64).reshape(-1, 2)
            d = np.bitwise_count(x[links[:, 0]] ^ x[links[:, 1]]).sum(1, dtype=np.int32)
            yield node[links[:, 1]], node[links[:, 0]], d
            return
        for rows, ok, d, inside in _cross(node, label, size, x, radius, least):
            if every:
                ok &= ~inside[None] | (rows[:, None] < np.arange(len(x))[None])
                i, j = np.nonzero(ok)
                for k in range(0, len(i), 4096):
                    p, q = rows[i[k : k + 4096]], j[k : k + 4096]
                    new = first_met(t, x[p, :LANES], x[q, :LANES])
                    yield node[p[new]], node[q[new]], d[i[k : k + 4096], q][new]
                continue
            has = np.flatnonzero(ok.any(1))
            if not len(has):
                continue
            rows, ok, d = rows[has], ok[has], d[has]
            row = np.arange(len(rows))
            for j in (np.where(ok, d, 1 << 20).argmin(1), np.where(ok, node[None], np.iinfo(np.int64).max).argmin(1)):
                # Where the two met in an earlier table, that table has a partner as near, or as small, already.
                new = first_met(t, x[rows, :LANES], x[j, :LANES])
                yield node[rows][new], node[j][new], d[row, j][new]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out, waiting = None, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting
            a, b, d = (np.concatenate(c) for c in zip(*out, strict=True))
            out.clear()
            waiting = 0
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d.astype(np.int32))], names=["a", "b", "d"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t, k, node, label, size = (batch.column(i).to_numpy() for i in range(5))
            x = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(len(t), -1)
            edges = np.concatenate(([0], np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1, [len(t)]))
            runs = np.stack([edges[:-1], edges[1:]], 1)
            single = runs[:, 1] - runs[:, 0] < 2
            single[[0, -1]] = False  # a shard may go on in the next batch
            for i, j in runs[~single].tolist():
                now = (int(t[i]), int(k[i]))
                if now != key:
                    if held:
                        for found in shard(key[0], held):
                            out.append(found)
                            waiting += len(found[0])
                            if waiting > 50_000:
                                yield flush()
                    key, held = now, []
                held.append((node[i:j], label[i:j], size[i:j], x[i:j]))
        if held:
            for found in shard(key[0], held):
                out.append(found)
                waiting += len(found[0])
                if waiting > 50_000:
                    yield flush()
        if out:
            yield flush()

    placed = nodes.select("node", "label", "size", "fp").mapInArrow(place, "t int, key bigint, node bigint, label bigint, size bigint, fp binary")
    found = placed.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(search, "a bigint, b bigint, d int")
    if every:
        return found.select("a", "b")
    best = found.groupBy("a").agg(F.min(F.struct("d", "b")).alias("near"), F.min("b").alias("first"))
    return best.select("a", F.explode(F.array_distinct(F.array("near.b", "first"))).alias("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets (``node``, ``shingles``) have at least this Jaccard similarity."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2), batch.column(3), strict=True):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (p, q))
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(both >= similarity * (len(u) + len(v) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("r")), "b")
    return met.select("a", "b", "s", "r").mapInArrow(work, "a bigint, b bigint")


def _shingle_rows(words: int, prints: bool):
    """Map (doc_id, text, digest) to rows (doc_id, digest, cls, size, fp), or to (cls, shingles, sketch) once each in a slice."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t.encode(), words) for t in batch.column(1).to_pylist()]
        names = [xxhash.xxh3_128_digest(h.tobytes()) for h in found]
        if prints:
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(names, pa.binary()), pa.array([len(h) for h in found], pa.int64()), pa.array([_wide_print(h) for h in found], pa.binary())],
                names=["doc_id", "digest", "cls", "size", "fp"])
        once = dict(zip(names, found, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(once), pa.binary()), pa.array([h.tobytes() for h in once.values()], pa.binary()), pa.array([parity_sketch(h) for h in once.values()], pa.binary())],
            names=["cls", "shingles", "sketch"])
    return work


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``digest`` (XXH64 of the text), ``group`` and ``component_id`` of every row.

    Rows are in one group if links of at least ``similarity`` join them; ``component_id``
    is the least id of the group. Texts with one shingle set are one class, and classes are compared.
    """
    texts = keyed_text(docs, id_col, text_col).withColumn("digest", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    prints = stored(map_arrow(texts, _shingle_rows(words, True), f"doc_id {kind}, digest bigint, cls binary, size bigint, fp binary"), "simhash-docs")
    nodes = stored(prints.groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.min("digest").alias("digest"), F.min("size").alias("size"), F.min("fp").alias("fp"),
    ).withColumn("node", F.monotonically_increasing_id()), "simhash-nodes")
    radius = radius_of(similarity)
    bits = sampled_bits(nodes.count(), radius)
    # Two rounds link most of each group by few pairs; the last tests all pairs of what is still apart.
    labels = links = sets = None
    active = nodes
    for every in (False, False, True):
        now = active.withColumn("label", F.col("node")) if labels is None else active.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node"))
        pairs = stored(similar_candidates(now, radius, bits, similarity, every), "simhash-pairs")
        if sets is None:
            ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            active = stored(nodes.join(ends, "node", "left_semi"), "simhash-active")
            needed = texts.join(active.select("digest").distinct(), "digest", "left_semi").select("doc_id", "text", "digest")
            shingles = map_arrow(needed, _shingle_rows(words, False), "cls binary, shingles binary, sketch binary").dropDuplicates(["cls"])
            sets = stored(shingles.join(active.select("cls", "node"), "cls").select("node", "shingles", "sketch"), "simhash-sets")
            active = stored(active.join(sets.select("node", "sketch"), "node").withColumn("fp", F.concat("fp", "sketch")).drop("sketch"), "simhash-sketched")
        new = stored(verified(pairs, sets, similarity), "simhash-links")
        links = new if links is None else links.unionAll(new)
        labels = components(links)
    named = nodes.join(labels, "node", "left").select("cls", "least", F.coalesce("root", "node").alias("group"))
    firsts = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(firsts, "group").select("cls", "group", "component_id"), "cls").select("doc_id", "digest", "group", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of ``similar_groups``: the one with the least id; of rows
    that share it the one with the least digest; rows that repeat both are one."""
    mark, digest, least = (spare_name(n, docs) for n in ("__print", "__digest", "__id"))
    groups = similar_groups(docs, id_col, text_col, words, similarity)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("group").agg(
        F.min("digest").alias(digest), F.min("doc_id").alias(least)).drop("group")
    rows = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    met = rows.join(kept, (rows[mark] == kept[digest]) & rows[id_col].eqNullSafe(kept[least]), "left_semi")
    return met.dropDuplicates([mark, id_col]).drop(mark)
