"""Cutting a log of any length into its entries, block by block.

The JSON reader takes a log as one value and so only up to a size. Here a state machine
goes over the bytes of a payload in blocks and keeps only whether it is inside a
string, whether the next byte is escaped, how deep it is, and the entry at hand. What
comes out is one row per entry, as text; the reader then sees entries only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that the state machine takes at once, and bytes of entries sent at once.
BLOCK_BYTES, SENT_BYTES = 1 << 20, 4 << 20
_SPACE = b" \t\n\r"
_STEP = np.zeros(256, np.int64)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1


class Splitter:
    """Feed the bytes of a JSON array in blocks, get the texts of its elements.

    ``valid`` says at the end whether the text was one array with nothing around it; whether
    the elements are JSON themselves is left to who reads them.
    """

    def __init__(self) -> None:
        self.inside = False   # in a string
        self.escaped = False  # the next byte is
        self.depth = 0
        self.begun = self.opened = self.ended = self.broken = False
        self.held = bytearray()
        self.count = 0

    def feed(self, block: bytes) -> Iterator[bytes]:
        if not self.begun:
            block = block.lstrip(_SPACE)
            if not block:
                return
            self.begun, self.broken = True, block[:1] != b"["
        if self.broken:
            return
        if self.ended:
            self.broken = bool(block.strip(_SPACE))
            return
        data = np.frombuffer(block, np.uint8)
        quotes = np.flatnonzero((data == ord('"')) & ~self._escaped(data))
        string = np.zeros(len(data), np.int64)
        string[quotes] = 1
        string = (np.cumsum(string) + self.inside) & 1
        self.inside = bool(string[-1])
        step = np.where(string == 0, _STEP[data], 0)
        depth = self.depth + np.cumsum(step)
        self.depth = int(depth[-1])
        commas = np.flatnonzero((data == ord(",")) & (string == 0) & (depth == 1))
        closing = np.flatnonzero((step < 0) & (depth <= 0))
        last = int(closing[0]) if len(closing) else len(data)
        at, self.opened = int(not self.opened), True  # the first byte is the bracket of the array
        for cut in commas[commas < last].tolist():
            self.held += block[at:cut]
            yield self._entry()
            at = cut + 1
        self.held += block[at:last]
        if len(closing):
            self.ended = True
            self.broken |= block[last : last + 1] != b"]" or bool(block[last + 1 :].strip(_SPACE))
            if self.count or self.held.strip(_SPACE):
                yield self._entry()

    def _escaped(self, data: np.ndarray) -> np.ndarray:
        """Which bytes stand behind an odd run of backslashes."""
        out = np.zeros(len(data), bool)
        places = np.flatnonzero(data == ord("\\"))
        first_escaped = self.escaped
        self.escaped = False
        if first_escaped:
            out[0] = True
            places = places[places > 0]
        if len(places):
            run = np.cumsum(np.concatenate(([True], np.diff(places) != 1)))
            start = places[np.concatenate(([True], np.diff(run) != 0))][run - 1]
            opening = (places - start) % 2 == 0  # every second one escapes what follows
            behind = places[opening] + 1
            self.escaped = bool(len(behind)) and int(behind[-1]) == len(data)
            out[behind[behind < len(data)]] = True
        return out

    def _entry(self) -> bytes:
        entry = bytes(self.held.strip(_SPACE))
        self.held = bytearray()
        self.count += 1
        self.broken |= not entry
        return entry

    @property
    def valid(self) -> bool:
        return self.begun and self.ended and not self.broken


def split_text(payload: memoryview) -> Iterator[tuple[int, bytes | None, bool | None]]:
    """(place, entry, None) of every entry, then (number of entries, None, whether it was an array)."""
    machine, place = Splitter(), 0
    for at in range(0, len(payload), BLOCK_BYTES):
        for entry in machine.feed(bytes(payload[at : at + BLOCK_BYTES])):
            yield place, entry, None
            place += 1
    yield place, None, machine.valid


def split_logs(envelopes: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """The ``keys`` with ``pos`` and ``entry`` of every entry, and one more row per log with ``whole``.

    A log of any length is cut without being read as a whole; ``whole`` is false for what
    is no array. A null payload counts as empty. Rows of one log come in their order.
    """
    given = envelopes.select(*keys, F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    n = len(keys)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows: list[tuple] = []
                size = 0
                for row in split_text(memoryview(batch.column(n)[i].as_buffer())):
                    rows.append(row)
                    size += len(row[1] or b"")
                    if size > SENT_BYTES or row[2] is not None:
                        same = pa.array([i] * len(rows), pa.int64())
                        place, entry, whole = zip(*rows, strict=True)
                        text = [None if e is None else e.decode("utf-8", "replace") for e in entry]
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(k).take(same) for k in range(n)), pa.array(place, pa.int64()), pa.array(text, pa.string()), pa.array(whole, pa.bool_())],
                            names=[*keys, "pos", "entry", "whole"])
                        rows, size = [], 0

    return given.mapInArrow(run, f"{kinds}, pos bigint, entry string, whole boolean")
