"""Quality classifier on supervised subword embeddings.

A word is the mean of the learned vectors of its character n-grams (3 to 5, with word
ends) and of itself; a document is the mean of its words plus the mean of its word
bigrams. A word that repeats the one before counts as one common bigram, a back
reference, whatever the word. All units are hashed into ``BUCKETS`` rows. A softmax over
the document vector gives the classes; vectors and softmax are trained together by
stochastic gradient descent in numpy.

Training takes at most ``TRAIN_ROWS`` labelled rows, one for each picked id and label
(ids by their hash; of rows with one id the text of the least hash). Their hashed units,
not their texts, come to the driver, and of a row no more than ``TRAIN_UNITS``: a
text with more gives a sample of them, another one for each text. So training holds at most
``8 * TRAIN_ROWS * TRAIN_UNITS`` bytes (25 MB) whatever the texts or repeated ids. A trained model is linear in
the units, so what the tasks need is one number per bucket (``4 * BUCKETS`` bytes) and a
bias: every document is scored over its whole text.

Results: a null text counts as empty; a text without words has the score of the bias.
Rows may repeat, each is scored alike. Without usable labels every score is 0.5. Labels
that are null count for nothing. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import bytes_of, joined, keyed_text, map_arrow, ragged, slices

BUCKETS, DIMENSIONS = 1 << 18, 16
NGRAMS = (3, 4, 5)
#: Most labelled rows that training looks at.
TRAIN_ROWS = 3000
#: Most units of one training row.
TRAIN_UNITS = 1024
EPOCHS, RATE = 12, 0.6
KEEP_FROM = 0.3
#: Bytes of text analysed at once: n-grams take some hundred bytes for each.
SLICE = 1 << 20
BACK = 0  # bucket of the back reference
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (1 + _mixed(h) % np.uint64(BUCKETS - 1)).astype(np.int64)


def _subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: buckets of its units (flat), their number, and the word's hash."""
    texts = ["\x02" + w.decode("utf-8", "replace") + "\x03" for w in words]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = np.cumsum(size)
    place = np.arange(len(code)) - np.repeat(end - size, size)
    left = np.repeat(end, size) - np.arange(len(code))
    owner = np.repeat(np.arange(len(words)), size)
    power = np.cumprod(np.full(int(size.max()) + 1, _A, np.uint64))
    whole = _mixed(np.add.reduceat(_mixed(code * _A + place.astype(np.uint64)) * power[np.minimum(place, len(power) - 1)], end - size))
    owners, units = [np.arange(len(words))], [_bucket(whole)]
    for n in NGRAMS:
        start = np.flatnonzero(left >= n)
        h = np.zeros(len(start), np.uint64)
        for k in range(n):
            h = h * _A + code[start + k] + np.uint64(1)
        owners.append(owner[start])
        units.append(_bucket(h + np.uint64(n)))
    owners, units = np.concatenate(owners), np.concatenate(units)
    order = np.argsort(owners, kind="stable")
    return units[order], np.bincount(owners, minlength=len(words)), whole


@dataclass
class Units:
    """Words and bigrams of a batch of texts."""

    counts: np.ndarray    # words of each text
    code: np.ndarray      # distinct word of each word
    units: np.ndarray     # buckets of the distinct words, flat
    sizes: np.ndarray     # how many each distinct word has
    bigrams: np.ndarray   # bucket of each bigram
    pairs: np.ndarray     # bigrams of each text


def analyse(texts: pa.Array) -> Units:
    data, ends = bytes_of(texts)
    ink = ~_SPACE[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edges = ends[(ends > 0) & (ends < len(data))]
    first[edges] = ink[edges]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, ends))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Units(counts, none, none, none, none, np.zeros(len(counts), np.int64))
    before = np.concatenate(([0], np.cumsum(ink)))
    offsets = np.concatenate((before[starts], before[-1:])).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[ink]))]).dictionary_encode()
    code = words.indices.to_numpy().astype(np.int64)
    units, sizes, whole = _subwords(words.dictionary.to_pylist())
    inner = np.ones(len(code), bool)
    inner[np.searchsorted(starts, ends[:-1])[counts > 0]] = False
    second = np.flatnonzero(inner)
    a, b = code[second - 1], code[second]
    bigrams = np.where(a == b, BACK, _bucket(whole[a] * _A + whole[b]))
    return Units(counts, code, units, sizes, bigrams, np.maximum(counts - 1, 0))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    last = np.cumsum(counts)
    return total[last] - total[last - counts]


def scores(texts: pa.Array, weight: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 of every text under one number per bucket."""
    u = analyse(texts)
    word = _sums(weight[u.units], u.sizes) / np.maximum(u.sizes, 1)
    z = bias + _sums(word[u.code], u.counts) / np.maximum(u.counts, 1) + _sums(weight[u.bigrams], u.pairs) / np.maximum(u.pairs, 1)
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def hashed_units(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and weights of every text, for training."""
    u = analyse(texts)
    at = np.cumsum(u.sizes) - u.sizes
    out, w, p = [], 0, 0
    for n, m in zip(u.counts, u.pairs, strict=True):
        code = u.code[w : w + n]
        ids = np.concatenate((u.units[ragged(at[code], u.sizes[code])], u.bigrams[p : p + m]))
        weight = np.concatenate((np.repeat(1 / np.maximum(u.sizes[code], 1) / max(n, 1), u.sizes[code]), np.full(m, 1 / max(m, 1))))
        ids, inverse = np.unique(ids, return_inverse=True)
        weight = np.bincount(inverse, weights=weight, minlength=len(ids))
        if len(ids) > TRAIN_UNITS:
            own = np.uint64(n) * _A + ids.sum().astype(np.uint64)
            part = np.sort(np.argpartition(_mixed(ids.astype(np.uint64) * _A + own), TRAIN_UNITS)[:TRAIN_UNITS])
            ids, weight = ids[part], weight[part] * (weight.sum() / weight[part].sum())
        out.append((ids.astype(np.int32), weight.astype(np.float32)))
        w, p = w + n, p + m
    return out


@dataclass
class Model:
    weight: np.ndarray
    bias: float


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """SGD over (label, buckets, weights); returns the model folded to one number per bucket."""
    rng = np.random.default_rng(8)
    vectors = ((rng.random((BUCKETS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS).astype(np.float32)
    softmax, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    done, total = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            label, ids, weight = rows[r]
            lr = rate * (1 - done / total)
            done += 1
            v = weight @ vectors[ids]
            z = v @ softmax + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = softmax @ p
            softmax -= lr * np.outer(v, p)
            bias -= lr * p
            vectors[ids] -= np.outer(lr * weight, back)
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    return Model(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the id as text leaves remainder 0 by 5 are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Train on at most ``rows`` labelled rows that are not held out."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    picked = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = hashed_units(batch.column(1))
        sizes = np.array([len(ids) for ids, _ in found])
        ids = np.concatenate([ids for ids, _ in found])
        weight = np.concatenate([w for _, w in found])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), joined(ids, sizes), joined(weight, sizes)], names=["doc_id", "label", "key", "ids", "weight"])

    texts = keyed_text(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label", F.xxhash64("text").alias("key"))
    units = map_arrow(texts, work, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label int, key bigint, ids binary, weight binary", SLICE)
    got = units.groupBy("doc_id", "label").agg(F.min(F.struct("key", "ids", "weight")).alias("u")).select("label", "u.ids", "u.weight").toArrow()
    rows_ = []
    for batch in got.to_batches():  # views of what arrived, not copies
        label, ids, weight = (batch.column(c) for c in ("label", "ids", "weight"))
        rows_ += [
            (label[k].as_py(), np.frombuffer(ids[k].as_buffer(), np.int32), np.frombuffer(weight[k].as_buffer(), np.float32))
            for k in range(batch.num_rows)]
    # The order of collected rows is not fixed; the order of training is.
    return train(sorted(rows_, key=lambda r: (r[0], len(r[1]), r[1][:64].tobytes(), r[2][:64].tobytes())))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1), *sent.value))], names=["doc_id", "score"])

    texts = keyed_text(docs, id_col, text_col)
    out = map_arrow(texts, work, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double", SLICE)
    return out.withColumn("predicted", (F.col("score") >= keep_from).cast("int"))


def keep_documents(docs: DataFrame, model: Model, text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` without the rows whose score is below ``keep_from``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at).fill_null("")
            parts = [scores(part.column(0), *sent.value) for part in slices(pa.RecordBatch.from_arrays([text], names=["text"]), limit=SLICE)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= keep_from))

    return docs.mapInArrow(run, docs.schema)
