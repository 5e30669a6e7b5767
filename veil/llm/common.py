"""Helpers shared by the operators of this package.

Every operator takes the names of the columns it reads, selects only those under
names of its own, and so is not disturbed by further columns of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.sources.tables import shared_folder, stored

__all__ = ["delete", "joined", "keyed_text", "map_arrow", "ragged", "shared_folder", "slices", "spare_name", "stored"]

#: Bytes of text that a task works on at once; one longer text is taken alone.
SLICE_BYTES = 4 << 20


def keyed_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of a table; a null text counts as empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def spare_name(name: str, df: DataFrame) -> str:
    """``name``, with underscores until the table has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``work`` to slices of Arrow batches, so that memory stays bounded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=limit):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds more than ``limit`` bytes of ``column``, or holds one row."""
    if not batch.num_rows:
        return
    ends = offsets_of(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
        end = min(end, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def offsets_of(strings: pa.Array) -> np.ndarray:
    """The n + 1 byte offsets of a string or binary array."""
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    raw = np.frombuffer(strings.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)


def bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and its offsets from 0."""
    ends = offsets_of(strings)
    data = strings.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, … of every run, one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def joined(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array whose elements are runs of ``values``."""
    ends = np.concatenate(([0], np.cumsum(counts))) * values.itemsize
    data = np.ascontiguousarray(values)
    if ends[-1] > 2**31 - 1:
        raise ValueError("more than 2 GB in one slice: a single text is too long for one row")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def delete(spark: SparkSession, df_or_path: str) -> None:
    """Remove a folder that this package wrote and no plan reads any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df_or_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
