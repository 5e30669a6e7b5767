"""Removal of repeated runs of lines through a suffix array of line ids.

Documents are sequences of lines; blank lines are not part of them. Every suffix gets
its rank by prefix doubling: round k orders suffixes by their first 2**k lines, from the
ranks of the two halves. Ranks are given to distinct pairs of halves, counted with
partial sums and sorted by range, so that a line which a third of all rows share is one
row of the sort; positions receive theirs by an equi-join that adaptive execution can
split. Suffixes whose prefix occurs once leave the array at once.

Suffixes with a common prefix of m lines are one interval of the array; two ranks, of
the first and of the last 2**k of the m lines, name it. The shortest windows of at least
``min_words`` words, from each line on and up to each line, are looked up in this way. A
window that is not the first of its interval is a later copy, and overlapping copies add
up to the maximal repeated runs. As every line has a word, windows have at most
``min_words`` lines and the doubling ends after log2 of that.

So a line is deleted if a run of lines around it, of ``min_words`` words or more, starts
earlier in the order of (id, line) as well; blank lines between two deleted ones go too.
Occurrences may overlap: of a line that repeats without end the first one stays.

Results: a null text counts as empty and stays empty. Rows that repeat id and text are
one occurrence and are cleaned alike. Null ids come first in the order. A document may
lose all lines; ``n_removed`` tells it from an empty one. An empty table gives an empty
table. Lines are the same if a 128-bit hash of their bytes is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import keyed_text, map_arrow, slices, spare_name, stored

MIN_WORDS = 50


def line_windows(text: str, min_words: int) -> tuple[list[int], list[bytes], np.ndarray, np.ndarray]:
    """Numbers and bytes of the lines with words, and the lengths (in lines, 0 for none) of the
    shortest windows of ``min_words`` words from each line on and up to each line."""
    numbers, lines, words = [], [], []
    for k, line in enumerate(text.encode().split(b"\n")):
        if n := len(line.split()):
            numbers.append(k), lines.append(line), words.append(n)
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    place = np.arange(len(lines))
    stop = np.searchsorted(total, total[:-1] + min_words)
    ahead = np.where(stop <= len(lines), stop - place, 0)
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    behind = np.where(total[1:] >= min_words, place + 1 - start, 0)
    return numbers, lines, ahead, behind


def _positions(texts: DataFrame, min_words: int) -> DataFrame:
    """One row per line with words: doc (id and hash of the text), at, line id, windows."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, at, low, high, ahead, behind = [], [], [], [], [], []
        digest = []
        for r, text in enumerate(batch.column(1).to_pylist()):
            digest.append(xxhash.xxh3_64_intdigest(text))
            _, lines, a, b = line_windows(text, min_words)
            row += [r] * len(lines)
            at += range(len(lines))
            ahead += a.tolist()
            behind += b.tolist()
            for line in lines:
                h = xxhash.xxh3_128_intdigest(line)
                low.append(h & 0xFFFFFFFFFFFFFFFF), high.append(h >> 64)
        index = pa.array(row, pa.int64())
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(index), signed(digest).take(index), pa.array(at, pa.int32()), signed(low), signed(high), pa.array(ahead, pa.int32()), pa.array(behind, pa.int32())],
            names=["doc_id", "digest", "at", "low", "high", "ahead", "behind"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = map_arrow(texts, work, f"doc_id {kind}, digest bigint, at int, low bigint, high bigint, ahead int, behind int")
    return rows.select(F.struct("doc_id", "digest").alias("doc"), "at", "low", "high", "ahead", "behind").dropDuplicates(["doc", "at"])


def _ranked(positions: DataFrame, halves: list[str]) -> DataFrame:
    """Ranks, in the order of ``halves``, of those that occur more than once."""
    several = positions.groupBy(*halves).agg(F.count("*").alias("n")).where("n > 1").select(*halves)
    return stored(several.repartitionByRange(*halves).sortWithinPartitions(*halves).withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def _later(windows: DataFrame, ranks: DataFrame, width: int) -> DataFrame:
    """Windows (doc, at, m) of width to 2 * width - 1 lines that are not the first of their interval."""
    head = windows.where((F.col("m") >= width) & (F.col("m") < 2 * width)).join(ranks.withColumnRenamed("rank", "r1"), ["doc", "at"])
    if width == 1:
        named = head.withColumn("r2", F.col("r1"))
    else:
        tail = ranks.select("doc", F.col("at").alias("tail"), F.col("rank").alias("r2"))
        named = head.withColumn("tail", F.col("at") + F.col("m") - width).join(tail, ["doc", "tail"])
    named = stored(named.select("doc", "at", "m", "r1", "r2"), "line-windows")
    # Written, so that the join has a plain exchange on either side: only such a join is split at a hot key.
    first = stored(named.groupBy("m", "r1", "r2").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n")).where("n > 1"), "line-intervals")
    return named.join(first, ["m", "r1", "r2"]).where(F.struct("doc", "at") > F.col("first")).select("doc", "at", "m")


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, at, m): windows that are later copies, counted in lines with words."""
    lines = stored(_positions(keyed_text(docs, id_col, text_col), min_words), "lines")
    names = _ranked(lines, ["low", "high"])
    active = stored(lines.join(names, ["low", "high"]).select("doc", "at", "rank", "ahead", "behind"), "line-positions")
    ranks = active.select("doc", "at", "rank")
    windows = active.select("doc", "at", F.col("ahead").alias("m")).unionAll(
        active.select("doc", (F.col("at") - F.col("behind") + 1).alias("at"), F.col("behind"))).where("m > 0").distinct()
    most = active.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    found, width = None, 1
    while width <= most:
        new = stored(_later(windows, ranks, width), "line-copies")
        found = new if found is None else found.unionAll(new)
        if 2 * width <= most:
            after = ranks.select("doc", (F.col("at") - width).alias("at"), F.col("rank").alias("second"))
            pairs = stored(ranks.join(after, ["doc", "at"]).withColumnRenamed("rank", "first"), "line-pairs")
            ranks = stored(pairs.join(_ranked(pairs, ["first", "second"]), ["first", "second"]).select("doc", "at", "rank"), "line-positions")
        width *= 2
    return found if found is not None else windows


def without_windows(text: str, windows: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the windows (first line with words, lines), the number of its lines, and of those removed."""
    lines = text.split("\n")
    inked = [k for k, line in enumerate(lines) if line.encode().split()]
    edge = np.zeros(len(inked) + 1, np.int64)
    for at, m in windows:
        edge[at] += 1
        edge[at + m] -= 1
    gone = np.zeros(len(lines), bool)
    before, last = False, -1
    for k, cut in zip(inked, np.cumsum(edge)[:-1] > 0, strict=True):
        gone[k] = cut
        gone[last + 1 : k] = before and cut
        before, last = cut, k
    return "\n".join([line for line, g in zip(lines, gone, strict=True) if not g]), len(lines), int(gone.sum())


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its repeated line runs cut from ``text_col``, and ``n_lines`` and ``n_removed`` (in the place of columns of these names)."""
    mark, least, cuts = (spare_name(n, docs) for n in ("__digest", "__id", "__windows"))
    copies = repeated_windows(docs, min_words, id_col, text_col)
    of_doc = copies.groupBy("doc").agg(F.collect_list(F.struct("at", "m")).alias(cuts)).select(
        F.col("doc.doc_id").alias(least), F.col("doc.digest").alias(mark), cuts)

    def digest(batch: pa.RecordBatch) -> pa.Array:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        return pa.array(np.array([xxhash.xxh3_64_intdigest(t or "") for t in texts], np.uint64).view(np.int64))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([digest(batch), *batch.columns], names=[mark, *batch.schema.names])

    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_removed")]
    rows = docs.select(*others, text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.mapInArrow(keyed, f"{mark} bigint, {fields}")
    met = rows.join(of_doc, rows[mark].eqNullSafe(of_doc[mark]) & rows[id_col].eqNullSafe(of_doc[least]), "left")
    met = met.select(*[rows[c] for c in others], rows[text_col], of_doc[cuts])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            renamed = pa.RecordBatch.from_arrays(batch.columns, names=[*(f"c{k}" for k in range(batch.num_columns - 2)), "text", "windows"])
            for part in slices(renamed):
                texts, counts, removed = [], [], []
                for text, windows in zip(part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True):
                    if windows:
                        text, n, gone = without_windows(text, [(w["at"], w["m"]) for w in windows])
                    else:
                        n, gone = (text or "").count("\n") + 1, 0
                    texts.append(text), counts.append(n), removed.append(gone)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                    names=[*others, text_col, "n_lines", "n_removed"])

    return met.mapInArrow(cut, f"{fields}, n_lines bigint, n_removed bigint").select(
        *(c for c in docs.columns if c not in ("n_lines", "n_removed")), "n_lines", "n_removed")
