"""BPE encoding and decoding with a contiguous rank array per word.

``encode`` cuts whole texts into words and encodes each distinct word once per
slice: the array of ranks of adjacent parts lies next to the parts, its minimum is
found by a scan, the boundary there is deleted and the two neighbouring ranks are
looked up anew. Words of more than ``LONG_WORD`` bytes use a heap over the same
parts, as a scan per merge would cost the square of the length.

A tokenizer file (``tokenizers`` JSON, byte-level BPE) is a parameter; nothing is
trained or copied. Every task reads it once. Added tokens of the file that occur
in a text become their own ids, as in the library with ``add_special_tokens=False``.

Results: null text counts as empty and has no ids; rows may repeat and each gets its
own result; an empty table gives an empty table; only the two named columns are read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from veil.llm.common import bytes_of, joined, keyed_text, map_arrow, ragged

LONG_WORD = 400
#: Encoded words a worker keeps; the table is emptied when it is full.
KEPT_WORDS = 250_000
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
#: Fixed values of byte-level BPE: contractions that are words of their own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
NEVER = 1 << 30


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
        elif kind == "Z":
            out[c] = SPACE
    out[[9, 10, 11, 12, 13, 0x85]] = SPACE
    return out


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of every byte of UTF-8; bytes within a character repeat its class."""
    table = _classes()
    out = np.zeros(len(data) + 3, np.uint8)
    out[: len(data)] = table[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32)
        first, more = padded[lead], [padded[lead + k] & 0x3F for k in (1, 2, 3)]
        two, three = first < 0xE0, first < 0xF0
        code = np.where(
            two, (first & 0x1F) << 6 | more[0],
            np.where(three, (first & 0x0F) << 12 | more[0] << 6 | more[1],
                     (first & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]),
        )
        kind = table[np.minimum(code, 0x10FFFF)]
        out[lead] = out[lead + 1] = kind
        out[lead[~two] + 2] = kind[~two]
        out[lead[~three] + 3] = kind[~three]
    return out[: len(data)]


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte offsets at which words begin. ``bounds`` are offsets that no word crosses."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _byte_classes(data)
    bounds = bounds[(bounds > 0) & (bounds < n)]
    edge = np.zeros(n + 1, bool)
    edge[0] = edge[n] = True
    edge[1:n] = kind[1:] != kind[:-1]
    edge[bounds] = True
    hard = np.zeros(n + 1, bool)
    hard[0] = hard[n] = True
    hard[bounds] = True

    run = np.flatnonzero(edge)
    start, end = run[:-1], run[1:]
    # White space before other characters gives its last one away: a plain space
    # joins the next word, any other is a word of its own.
    before = (kind[start] == SPACE) & ~hard[end]
    start, end = start[before], end[before]
    last = end - 1
    while len(back := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[back] -= 1
    edge[last] = True
    plain = data[last] == 0x20
    edge[end[plain]] = False

    # An apostrophe that begins a word takes a known ending of letters with it.
    quote = np.flatnonzero(data == 0x27)
    if len(quote):
        quote = quote[edge[quote] & edge[quote + 1] & ~hard[quote + 1]]
        if len(quote):
            padded = np.concatenate((data, np.zeros(2, np.uint8)))
            near = np.concatenate((hard, np.ones(2, bool)))
            left = np.ones(len(quote), bool)
            for ending in CONTRACTIONS:
                hit = left.copy()
                for k, c in enumerate(ending.encode()):
                    hit &= padded[quote + 1 + k] == c
                    if k:
                        hit &= ~near[quote + 1 + k]
                at = quote[hit]
                edge[at + 1] = False
                edge[at + 1 + len(ending)] = True
                left &= ~hit
    return np.flatnonzero(edge[:n])


class Tokenizer:
    """Tables of one tokenizer file and the words encoded so far by this worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normalizer is needed")
        # Byte-level files write a byte as itself if it is printable, else as the
        # next free character from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        as_byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for text, i in vocab.items():
            self.token[i] = bytes(as_byte[c] for c in text) if text not in self.added else text.encode()
        for text, i in self.added.items():
            self.token[i] = text.encode()
        self.of_byte = [0] * 256
        for c, b in as_byte.items():
            self.of_byte[b] = vocab[c]
        self.merged: list[int] = []
        self.rank: dict[int, int] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << 32 | vocab[b]] = k
            self.merged.append(vocab[a + b])
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))).encode()) if self.added else None
        self.words: dict[bytes, bytes] = {}
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.token))]

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word by repeated deletion of the boundary of least rank."""
        parts = [self.of_byte[b] for b in word]
        rank = self.rank.get
        if len(parts) > LONG_WORD:
            return self._encode_long(parts)
        ranks = [rank(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            parts[i] = self.merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], NEVER)
        return parts

    def _encode_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        heap = [(r, i) for i in range(n - 1) if (r := rank(parts[i] << 32 | parts[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else n
            if j >= n or rank(parts[i] << 32 | parts[j], NEVER) != r:
                continue
            parts[i], parts[j] = self.merged[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (s := rank(parts[a] << 32 | parts[after[a]], NEVER)) != NEVER:
                    heapq.heappush(heap, (s, a))
        return [p for p in parts if p >= 0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        data, ends = bytes_of(texts)
        whole = np.zeros(0, np.int64)
        bounds = ends
        if self.special and len(data):
            found = [m.span() for m in self.special.finditer(data.tobytes())]
            if found:
                spans = np.array(found, np.int64)
                inside = np.searchsorted(ends, spans[:, 0], side="right") == np.searchsorted(ends, spans[:, 1], side="left")
                spans = spans[inside]
                whole = spans[:, 0]
                bounds = np.unique(np.concatenate((ends, spans.ravel())))
        starts = word_starts(data, bounds)
        if len(whole):
            inside = np.zeros(len(data) + 1, np.int8)
            np.add.at(inside, spans[:, 0] + 1, 1)
            np.add.at(inside, spans[:, 1], -1)
            starts = starts[np.cumsum(inside)[starts] == 0]
        counts = np.diff(np.searchsorted(starts, ends))
        if not len(starts):
            return np.zeros(0, np.uint32), counts
        offsets = np.concatenate((starts, [len(data)])).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        known, ids_of = self.words.get, self._ids
        distinct = [known(w) or ids_of(w) for w in coded.dictionary.to_pylist()]
        if len(whole):
            coded_special = {w: i for i, w in enumerate(coded.dictionary.to_pylist()) if w.decode(errors="ignore") in self.added}
            for w, i in coded_special.items():
                distinct[i] = self.added[w.decode()].to_bytes(4, "little")
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) >> 2
        flat = np.frombuffer(b"".join(distinct), "<u4")
        code = coded.indices.to_numpy()
        per_word = sizes[code]
        ids = flat[ragged((np.cumsum(sizes) - sizes)[code], per_word)]
        total = np.concatenate(([0], np.cumsum(per_word)))
        last = np.cumsum(counts)
        return ids, total[last] - total[last - counts]

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word as little-endian numbers of four bytes."""
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            ids = self.encode_word(word)
            got = np.array(ids, "<u4").tobytes() if len(ids) > 12 else b"".join([self.packed[i] for i in ids])
            if len(word) <= LONG_WORD:
                self.words[word] = got
        return got

    def decode(self, ids: np.ndarray) -> str:
        token = self.token
        return b"".join([token[i] for i in ids.tolist()]).decode("utf-8", "replace")


class LibraryTokenizer(Tokenizer):
    """The same tables and words, each word being encoded by the ``tiktoken`` library.

    For operators that only need the ids. Its ranks are token ids, so it takes files whose
    merges are numbered in order, and all others are encoded by the rank array.
    """

    def __init__(self, path: str):
        super().__init__(path)
        in_order = all(a < b for a, b in zip(self.merged, self.merged[1:], strict=False))
        if in_order and max(self.of_byte) < min(self.merged):
            ordinary = {t: i for i, t in enumerate(self.token) if t and t.decode("utf-8", "replace") not in self.added}
            # Words come one by one, so all of a word is one piece.
            self.library = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ordinary, special_tokens={})

            def encode_word(word: bytes) -> list[int]:
                return self.library.encode_ordinary(word.decode()) if len(word) <= LONG_WORD else Tokenizer.encode_word(self, word)

            self.encode_word = encode_word


@lru_cache(maxsize=2)
def tokenizer(path: str, library: bool = False) -> Tokenizer:
    return LibraryTokenizer(path) if library else Tokenizer(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit numbers) of every text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = tokenizer(path).encode(batch.column(1))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), joined(ids.astype("<u4"), counts)],
            names=["doc_id", "n_tokens", "ids"],
        )

    texts = keyed_text(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts, work, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The table of ``encode`` with the ``text`` that its ids stand for; null ids give an empty text.

    Bytes that are no UTF-8 become U+FFFD; ids that the tokenizer lacks raise IndexError.
    """
    def run(batches):
        known = tokenizer(path)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [known.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, text string")
