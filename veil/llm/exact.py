"""Exact dedup through an extendible-hash index on shared files.

1. Keys are 64-bit hashes of whole texts. The directory is doubled until no bucket
   holds more keys than its capacity: a bucket is a prefix of the hash, an overfull
   one is split by the following bits, and keys are counted anew below it only. The
   capacity grows with the table, so that the directory has at most ``DIRECTORY``
   entries for any number of keys and can be sent to the tasks.
2. Copies within a batch are collapsed before anything is shuffled, so a text that a
   third of all rows share reaches its owner once a batch.
3. An owner task reads its buckets in key order. Entries of one key form a chain; a
   new entry is compared byte by byte with each text of the chain, joins its group or
   becomes a new link. The chains are written to the shared folder: the index.
4. Every row finds its group in the index by key and digest, in an equi-join that
   adaptive execution can split at a hot key.

Results: a null text counts as empty, so null and empty texts are one group. Of equal
texts the row with the largest id stays; rows with null ids stay only where the whole
group has no other, and repeated rows with that id all count as the one that stays.
An empty table gives an empty table. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import keyed_text, map_arrow, stored

#: Keys of a bucket, for tables of up to BUCKET_KEYS * DIRECTORY / 2 keys.
BUCKET_KEYS = 256
#: Most entries of the directory (bytes sent to a task: 24 each).
DIRECTORY = 1 << 16
#: Bits that a split of an overfull bucket looks at in one pass.
STEP = 4


def directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS, entries: int = DIRECTORY) -> list[tuple[int, int]]:
    """Buckets as (first hash, depth), by first hash; ``keys`` has one row per hash ``h``.

    Counts per prefix come from Spark; only prefixes of overfull buckets are asked for
    again, one level of ``STEP`` bits deeper each time. Prefixes are of the hash as an
    unsigned number. Depth 64 is a single key and never splits.
    """
    capacity = max(bucket_keys, -(-keys.count() * 2 // entries))
    done: list[tuple[int, int]] = []
    overfull, base = [0], 0
    while overfull:
        deep = min(base + STEP, 64)
        prefix = F.shiftrightunsigned("h", 64 - deep)
        found = keys
        if base:
            found = keys.where(F.shiftrightunsigned("h", 64 - base).isin(overfull))
        counts = {p: n for p, n in found.groupBy(prefix.alias("p")).agg(F.count("*")).toLocalIterator()}
        split: list[int] = []
        for top in overfull:
            # Double the directory from one bucket on; each holds a range of the prefixes.
            width = 1 << (deep - base)
            below = np.array([counts.get((top << (deep - base)) + k, 0) for k in range(width)])
            todo = [(0, width, base)]
            while todo:
                start, size, depth = todo.pop()
                if below[start : start + size].sum() <= capacity or depth == 64:
                    done.append((((top << (deep - base)) + start) << (64 - deep), depth))
                elif size == 1:
                    split.append((top << (deep - base)) + start)
                else:
                    half = size // 2
                    todo += [(start, half, depth + 1), (start + half, half, depth + 1)]
        overfull, base = split, deep
    return sorted(done)


def _collapsed(texts: DataFrame, starts: np.ndarray) -> DataFrame:
    """Entries (bucket, h, text, keep_id, n): copies of one batch are one entry."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(1).dictionary_encode()
        first = np.unique(text.indices.to_numpy(), return_index=True)[1]
        groups = (
            pa.table({"code": text.indices, "doc_id": batch.column(0)})
            .group_by("code", use_threads=False).aggregate([("doc_id", "max"), ("code", "count")]).sort_by("code")
        )
        h = batch.column(2).take(pa.array(first))
        bucket = np.searchsorted(starts, h.to_numpy().view(np.uint64), side="right") - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), h, batch.column(1).take(pa.array(first)),
             groups.column("doc_id_max").combine_chunks(), groups.column("code_count").combine_chunks()],
            names=["bucket", "h", "text", "keep_id", "n"],
        )

    hashed = texts.withColumn("h", F.xxhash64("text"))
    return map_arrow(hashed, work, f"bucket int, h bigint, text string, keep_id {kind}, n bigint")


def _chain(entries: list[tuple]) -> list[list]:
    """Groups [text, keep_id, n] of the entries of one key, by comparing bytes."""
    links: list[list] = []
    for text, keep, n in entries:
        for link in links:
            if link[0] == text:
                link[2] += n
                if link[1] is None or keep is not None and keep > link[1]:
                    link[1] = keep
                break
        else:
            links.append([text, keep, n])
    return links


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The index: bucket, h, link (place in the chain), text_sha256, keep_id, group_size."""
    texts = keyed_text(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    keys = stored(texts.select(F.xxhash64("text").alias("h")).distinct(), "exact-keys")
    starts = np.array([start for start, _ in directory(keys, bucket_keys)], np.uint64)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at: tuple | None = None

        def close(out: list[tuple]) -> None:
            for k, (text, keep, n) in enumerate(_chain(held)):
                out.append((*at, k, hashlib.sha256(text).hexdigest(), keep, n))
            held.clear()

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in out], schema=schema)

        names = ["bucket", "h", "link", "text_sha256", "keep_id", "group_size"]
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([("bucket", pa.int32()), ("h", pa.int64()), ("link", pa.int32()), ("text_sha256", pa.string()),
                                    ("keep_id", batch.schema.field("keep_id").type), ("group_size", pa.int64())])
            out: list[tuple] = []
            bucket, h, keep, n = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            text = pc.cast(batch.column(2), pa.binary())
            for i in range(batch.num_rows):
                if (bucket[i], h[i]) != at:
                    close(out)
                    at = (bucket[i], h[i])
                value = text[i].as_py()
                if held and held[-1][0] == value:  # sorted runs of one text stay one entry
                    last = held[-1]
                    best = keep[i] if last[1] is None or keep[i] is not None and keep[i] > last[1] else last[1]
                    held[-1] = (value, best, last[2] + n[i])
                else:
                    held.append((value, keep[i], n[i]))
            if out:
                yield batch_of(out)
        out = []
        close(out)
        if out:
            yield batch_of(out)

    entries = _collapsed(texts, starts).repartition("bucket").sortWithinPartitions("bucket", "h", "text")
    schema = f"bucket int, h bigint, link int, text_sha256 string, keep_id {kind}, group_size bigint"
    return stored(entries.mapInArrow(own, schema), "exact-index")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, id_col, text_col).select("h", "text_sha256", "keep_id", "group_size")
    rows = keyed_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("h"), F.sha2(F.encode("text", "utf-8"), 256).alias("text_sha256")
    )
    return rows.join(index, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
