"""Best-fit packing of token sequences by linear grouping.

Only the number of pieces of each length reaches the driver: ``capacity`` numbers, for any
number of documents. The plan is made on them:

1. Lengths above ``capacity / SMALL_PART`` are large. They are put in order and cut into
   ``GROUPS`` groups of equal cardinality; each is rounded up to the longest of its group.
2. The few sizes left are packed optimally: a linear programme over configurations,
   solved by column generation (a knapsack finds the next configuration), rounded down.
3. Actual lengths take the places of the rounded ones, the last place of a configuration
   going to the longest one that still fits.
4. The large ones that rounding left over, and then the small ones, longest first, each
   go where the least room remains.

A plan is a list of stretches of equal sequences, a few thousand at most, so it is sent to
all tasks. Documents then find their place by their rank among the pieces of their length. Ranks
come from counts of (length, bucket), with as many buckets as a length needs to stay at
the square root of all pieces, so no length is ranked in one task.

Results: a null text counts as empty and is one piece, the end token. Documents above the
capacity are cut into full pieces, the first taking the rest. Rows may repeat; each has
pieces of its own. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veil.llm.bpe import tokenizer
from veil.llm.common import keyed_text, map_arrow, stored

CAPACITY, END_ID = 1024, 2
SMALL_PART, GROUPS = 8, 40
#: Rounds of column generation; the programme is solved long before.
MAX_COLUMNS = 2000


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` of every piece."""
    texts = keyed_text(docs, id_col, text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = tokenizer(path, library=True).encode(batch.column(1))
        row, piece, start, length, crc, data = [], [], [], [], [], []
        at = 0
        for r, n in enumerate(counts.tolist()):
            own = np.append(ids[at : at + n], end_id).astype("<u4")
            at += n
            begin, end, k = 0, len(own) % capacity or capacity, 0
            while begin < len(own):
                part = own[begin:end].tobytes()
                row.append(r), piece.append(k), start.append(begin), length.append(end - begin), crc.append(zlib.crc32(part))
                if keep_ids:
                    data.append(part)
                begin, end, k = end, end + capacity, k + 1
        arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(data, pa.binary())] * keep_ids, names=names + ["ids"] * keep_ids)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts, work, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids)


@dataclass
class Stretch:
    """``count`` sequences from ``first`` on, with ``room`` left in each."""

    first: int
    count: int
    room: int


@dataclass
class Plan:
    """Where pieces go: of ``length``, from ``rank`` on, ``each`` in every sequence from ``first``, at ``offset``."""

    rows: list[tuple[int, int, int, int, int]]
    sequences: int


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
    """Linear grouping: (longest, shortest, pieces) of groups of equal cardinality, longest first."""
    total = sum(counts.values())
    share = max(1, -(-total // groups))
    out: list[list[int]] = []
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not out or out[-1][2] == share:
                out.append([length, length, 0])
            take = min(n, share - out[-1][2])
            out[-1][1] = length
            out[-1][2] += take
            n -= take
    merged: dict[int, list[int]] = {}
    for longest, shortest, n in out:  # one size per group; equal sizes are one group
        old = merged.setdefault(longest, [shortest, 0])
        old[0] = min(old[0], shortest)
        old[1] += n
    return [(size, low, n) for size, (low, n) in sorted(merged.items(), reverse=True)]


def _best_configuration(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """The configuration of most worth: an unbounded knapsack over all capacities."""
    best, last = [0.0] * (capacity + 1), [-1] * (capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        for g, s in enumerate(sizes):
            if s <= c and best[c - s] + worth[g] > best[c] + 1e-12:
                best[c], last[c] = best[c - s] + worth[g], g
    use, c = [0] * len(sizes), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            use[last[c]] += 1
            c -= sizes[last[c]]
    return best[capacity], use


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, places of each size): the optimal fractional packing, rounded down."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    inverse = np.linalg.inv(basis)
    amount = inverse @ np.array(demand, float)
    for _ in range(MAX_COLUMNS):
        worth = inverse.sum(0)
        value, use = _best_configuration(sizes, np.maximum(worth, 0), capacity)
        if value <= 1 + 1e-9:
            break
        column = np.array(use, float)
        direction = inverse @ column
        ratio = np.full(n, np.inf)
        np.divide(amount, direction, out=ratio, where=direction > 1e-10)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = column
        inverse = np.linalg.inv(basis)
        amount = np.maximum(inverse @ np.array(demand, float), 0)
    return [(int(amount[k] + 1e-9), [int(x) for x in basis[:, k]]) for k in range(n) if amount[k] >= 1]


class _Packer:
    """Builds a plan from the number of pieces of each length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.left)  # with pieces left
        self.rank = dict.fromkeys(self.left, 0)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.rooms: dict[int, list[Stretch]] = {}
        self.sizes: list[int] = []  # rooms with stretches, in order

    def place(self, length: int, each: int, stretch: Stretch, total: int | None = None) -> None:
        """Put ``each`` pieces (``total`` in all, if fewer) into every sequence of a stretch."""
        n = each * stretch.count if total is None else total
        self.rows.append((length, self.rank[length], stretch.first, each, self.capacity - stretch.room))
        self.rank[length] += n
        self.left[length] -= n
        stretch.room -= each * length
        if not self.left[length]:
            self.lengths.pop(bisect_left(self.lengths, length))

    def open(self, count: int) -> Stretch:
        self.sequences += count
        return Stretch(self.sequences - count, count, self.capacity)

    def put(self, stretch: Stretch) -> None:
        if stretch.count and stretch.room:
            if stretch.room not in self.rooms:
                self.rooms[stretch.room] = []
                insort(self.sizes, stretch.room)
            self.rooms[stretch.room].append(stretch)

    def longest(self, upto: int, least: int, used: dict[int, int]) -> int | None:
        """The longest length in [least, upto] with a piece left beyond ``used``."""
        k = bisect_left(self.lengths, upto + 1) - 1
        while k >= 0 and self.lengths[k] >= least:
            if self.left[self.lengths[k]] > used.get(self.lengths[k], 0):
                return self.lengths[k]
            k -= 1
        return None

    def substitute(self, times: int, places: list[tuple[int, int]], least: int) -> None:
        """Fill a configuration with actual lengths; ``places`` are (longest, shortest), longest first."""
        while times:
            used: dict[int, int] = {}
            room = self.capacity
            for k, (high, low) in enumerate(places):
                final = k == len(places) - 1
                length = self.longest(room if final else min(high, room), least if final else low, used)
                if length is None and not final:
                    return
                if length is not None:
                    used[length] = used.get(length, 0) + 1
                    room -= length
            if not used:
                return
            count = min(times, *(self.left[x] // n for x, n in used.items()))
            stretch = self.open(count)
            for length in sorted(used, reverse=True):
                self.place(length, used[length], stretch)
            self.put(stretch)
            times -= count

    def best_fit(self, length: int) -> None:
        """Put all pieces of one length where the least room remains; open sequences for the rest."""
        while self.left.get(length):
            n = self.left[length]
            k = bisect_left(self.sizes, length)
            if k < len(self.sizes):
                room = self.sizes[k]
                stretch = self.rooms[room].pop()
                if not self.rooms[room]:
                    del self.rooms[room]
                    self.sizes.pop(k)
            else:
                stretch = self.open(-(-n // (self.capacity // length)))
            each = stretch.room // length
            whole = min(stretch.count, n // each)
            if whole:
                part = Stretch(stretch.first, whole, stretch.room)
                self.place(length, each, part)
                self.put(part)
            rest = n - whole * each
            if whole < stretch.count and rest:
                part = Stretch(stretch.first + whole, 1, stretch.room)
                self.place(length, rest, part)
                self.put(part)
                whole += 1
            self.put(Stretch(stretch.first + whole, stretch.count - whole, stretch.room))


def make_plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan for so many pieces of each length."""
    packer = _Packer(counts, capacity)
    small = capacity // SMALL_PART
    if counts.get(capacity):
        packer.place(capacity, 1, packer.open(counts[capacity]))
    large = {x: n for x, n in packer.left.items() if small < x < capacity and n}
    if large:
        sizes = grouped(large, groups)
        for times, use in sorted(configurations([s for s, _, _ in sizes], [n for _, _, n in sizes], capacity), key=lambda c: (sum(c[1]), c[1])):
            packer.substitute(times, [(s, low) for (s, low, _), n in zip(sizes, use, strict=True) for _ in range(n)], small + 1)
    for length in sorted(packer.left, reverse=True):
        packer.best_fit(length)
    return Plan(sorted(packer.rows), packer.sequences)


def pack(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces (its ``doc_id``, ``piece`` and ``length`` are read).

    The table is read twice, so it should be a written one.
    """
    counts = {r["length"]: r["n"] for r in pieces_.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = make_plan(counts, capacity)
    per_bucket = math.isqrt(sum(counts.values())) + 1
    buckets = F.array(*(F.lit(-(-counts.get(x, 0) // per_bucket) or 1) for x in range(1, capacity + 1)))
    rows = pieces_.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(buckets, F.col("length").cast("int"))))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")))
    ranked = ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("nth") - 1 + F.col("before")).select(*pieces_.columns, "rank")
    table = np.array(plan.rows, np.int64).reshape(-1, 5)
    names = [*pieces_.columns, "sequence_id", "offset"]
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            row = table[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, place = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(place)], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces_.schema.fields)
    return ranked.mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; see ``pieces`` and ``pack``."""
    return pack(stored(pieces(docs, path, capacity, END_ID, id_col, text_col, keep_ids), "pieces"), capacity)
