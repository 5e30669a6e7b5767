"""Toxic passages by maximum-scoring segments.

*Tokens* are maximal runs of ASCII letters and of bytes beyond ASCII, A-Z lower-cased. A
token's weight is its log-odds of standing in a toxic rather than in another labelled
document, with a Dirichlet prior in proportion to the share of *all* documents that hold
it. Tokens whose lower confidence bound reaches ``LEAST_ODDS`` are markers and score that
bound; every other token scores the same small negative number, the log-odds of meeting
no marker.

*Segments.* One linear scan (Ruzzo and Tompa) finds all maximal segments of a text. By the
theory of Karlin and Altschul a segment of score S in a text of n tokens is expected
``K n exp(-lambda S)`` times by chance: lambda follows from the scores under the clean
documents, K from the best segments of the clean documents by maximum likelihood. Segments
expected at most ``CHANCE`` times are the passages. Their ``-ln`` expectations are added up,
and a logistic curve fitted to the training rows turns the sum into a score.

Training looks at no more than ``TRAIN_ROWS`` labelled ids, picked by the hash of the id,
never held-out ones; texts with the same label and the same least hash of three-word
shingles, so copies and most near copies, count once. All counting is done by Spark; the
driver gets at most ``MAX_TERMS`` tokens of ``LONGEST`` bytes or fewer, and a histogram. The prior
is counted over the whole table, and every document is scored over its whole text.

Results: a null text counts as empty; a text without tokens or passages has the score of
an empty sum. Rows may repeat, each is scored alike. Labels other than 0 and 1, null labels
and null ids teach nothing. Without usable labels every score is 0.5. An empty table gives
an empty table. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import bytes_of, delete, keyed_text, map_arrow, shared_folder, slices

#: Most labelled ids that training looks at, and most markers of a model.
TRAIN_ROWS, MAX_TERMS = 20_000, 50_000
#: A marker occurs in this many distinct toxic training texts at least; bytes of the longest.
LEAST_TEXTS, LONGEST = 5, 64
#: Weight of the prior in documents, quantile of the confidence bound, least log-odds.
PRIOR, BOUND, LEAST_ODDS = 200.0, 1.64, math.log(3)
#: Chance segments a passage may be expected to have in its text.
CHANCE = 0.05
CUT = 0.5
#: Bytes of text analysed at once.
SLICE = 2 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tokens:
    """Tokens of a batch of texts."""

    counts: np.ndarray   # tokens of each text
    code: np.ndarray     # distinct word of each token
    words: pa.Array      # the distinct words, binary
    starts: np.ndarray   # first byte of each token in the batch
    ends: np.ndarray     # byte behind it


def tokens(texts: pa.Array) -> Tokens:
    data, ends = bytes_of(texts)
    ink = _LETTER[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    edges = ends[(ends > 0) & (ends < len(data))]
    first[edges] = ink[edges]
    last[edges - 1] = ink[edges - 1]
    starts, behind = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, ends))
    offsets = np.concatenate(([0], np.cumsum(behind - starts))).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[ink]])]
    ).dictionary_encode()
    return Tokens(counts, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary, starts, behind)


def _owners(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def _sketches(found: Tokens) -> np.ndarray:
    """Least hash of the three-word shingles of every text; 0 for fewer words."""
    hashes = np.array([hash_of(w) for w in found.words.to_pylist()], np.uint64)
    out = np.zeros(len(found.counts), np.uint64)
    if len(found.code) < 3:
        return out
    h = hashes[found.code]
    with np.errstate(over="ignore"):
        triple = (h[:-2] * _MIX + h[1:-1]) * _MIX + h[2:]
        triple = (triple ^ (triple >> np.uint64(31))) * _MIX
    owner = _owners(found.counts)
    inside = owner[:-2] == owner[2:]
    least = np.full(len(out), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, owner[:-2][inside], triple[inside])
    return np.where(found.counts >= 3, least, out)


def hash_of(word: bytes) -> int:
    """A 64-bit hash of a word that is the same in every process."""
    h = 0xCBF29CE484222325
    for at in range(0, len(word), 8):
        h = ((h ^ int.from_bytes(word[at : at + 8], "little")) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 29
    return h


def segments(places: list[int], weights: list[float], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last token) of a row of tokens.

    Tokens at ``places`` score ``weights`` (positive), all others ``drift`` (negative). Time is
    linear in the number of places: each candidate is pushed, passed over and merged once.
    """
    left: list[float] = []
    right: list[float] = []
    first: list[int] = []
    last: list[int] = []
    lower: list[int] = []  # the nearest earlier candidate that begins lower
    total, before = 0.0, -1
    for place, weight in zip(places, weights, strict=True):
        total += drift * (place - before - 1)
        before = place
        begins, total = total, total + weight
        start, j = place, len(left) - 1
        while j >= 0 and left[j] >= begins:
            j = lower[j]
        while j >= 0 and right[j] < total:
            begins, start, j_ = left[j], first[j], lower[j]
            for column in (left, right, first, last, lower):
                del column[j:]
            j = j_
        left.append(begins)
        right.append(total)
        first.append(start)
        last.append(place)
        lower.append(j)
    return [(r - b, s, e) for b, r, s, e in zip(left, right, first, last, strict=True)]


@dataclass
class Model:
    """Markers with their scores, and what calibrates segments and sums."""

    words: list[bytes]
    weights: np.ndarray
    drift: float = -1.0
    rate: float = 1.0        # lambda
    scale: float = 1.0       # K
    slope: float = 0.0
    offset: float = 0.0      # of the logistic curve

    def expected(self, score: float, size: int) -> float:
        """Chance segments of this score in a text of ``size`` tokens."""
        return self.scale * size * math.exp(-min(self.rate * score, 700.0))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * np.log1p(evidence), -500, 500)))

    def segments_of(self, found: Tokens) -> Iterator[tuple[int, int, list[tuple[float, int, int]]]]:
        """Text, place of its first token, and segments, of the texts that have a marker."""
        known = pc.index_in(found.words, pa.array(self.words, pa.binary())).to_numpy(zero_copy_only=False)
        weight = np.where(np.isnan(known), 0.0, np.append(self.weights, 0.0)[np.nan_to_num(known, nan=-1).astype(int)]) if len(self.words) else np.zeros(len(found.words))
        weight = weight[found.code]
        hits = np.flatnonzero(weight)
        ends = np.cumsum(found.counts)
        owner = np.searchsorted(ends, hits, side="right")
        for group in np.split(np.arange(len(hits)), np.flatnonzero(np.diff(owner)) + 1) if len(hits) else ():
            d = int(owner[group[0]])
            base = int(ends[d] - found.counts[d])
            yield d, base, segments((hits[group] - base).tolist(), weight[hits[group]].tolist(), self.drift)

    def evidence(self, found: Tokens) -> np.ndarray:
        """Sum of the ``-ln`` expectations of every text's significant segments."""
        out = np.zeros(len(found.counts))
        for d, _, parts in self.segments_of(found):
            n = int(found.counts[d])
            out[d] = sum(-math.log(max(e, 1e-300)) for e in (self.expected(s, n) for s, _, _ in parts) if e <= CHANCE)
        return out


def held_out(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the id as text leaves remainder 0 by 5 are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _training_texts(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """``label`` and ``text``: one row per label and sketch of the picked rows."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    texts = keyed_text(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").select("label", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sketch = pa.array(_sketches(tokens(batch.column(1))).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sketch], names=["label", "text", "sketch"])

    marked = map_arrow(texts, work, "label int, text string, sketch bigint", SLICE)
    return marked.groupBy("label", "sketch").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "text")


def _class_counts(train: DataFrame) -> DataFrame:
    """``word``, and by class the texts that hold it and its occurrences."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = tokens(batch.column(1))
        toxic = batch.column(0).to_numpy(zero_copy_only=False) == 1
        size, owner = len(found.words), _owners(found.counts)
        once = np.unique(owner * max(size, 1) + found.code)
        counts = []
        for mine in (toxic, ~toxic):
            counts += [np.bincount(once[mine[once // max(size, 1)]] % max(size, 1), minlength=size),
                       np.bincount(found.code[mine[owner]], minlength=size)]
        return pa.RecordBatch.from_arrays([found.words, *map(pa.array, counts)], names=["word", *COUNTS])

    parts = map_arrow(train, work, "word binary, " + ", ".join(f"{c} bigint" for c in COUNTS), SLICE)
    return parts.groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))


COUNTS = ("toxic_texts", "toxic_tokens", "clean_texts", "clean_tokens")


def _background(docs: DataFrame, words: list[bytes]) -> tuple[dict[bytes, int], int]:
    """How many of all documents hold each word, and how many documents there are."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = tokens(batch.column(1))
        mine = pa.array(sent.value, pa.binary())
        at = pc.index_in(found.words, mine).fill_null(-1).to_numpy(zero_copy_only=False)[found.code]
        size = len(mine)
        once = np.unique((_owners(found.counts) * size + at)[at >= 0])
        counts = np.bincount(once % size, minlength=size)
        some = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([-1, *some], pa.int64()), pa.array([batch.num_rows, *counts[some]], pa.int64())], names=["at", "n"])

    got = map_arrow(docs, work, "at bigint, n bigint", SLICE).groupBy("at").agg(F.sum("n").alias("n")).collect()
    sent.destroy()
    return {words[r["at"]]: r["n"] for r in got if r["at"] >= 0}, next((r["n"] for r in got if r["at"] < 0), 0)


def log_odds(hits: np.ndarray, of: float, other_hits: np.ndarray, other_of: float, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio of words between two classes under a Dirichlet prior, and its deviation."""
    prior = PRIOR * share
    a, b = hits + prior, other_hits + prior
    odds = np.log(a / np.maximum(of + PRIOR - a, 0.5)) - np.log(b / np.maximum(other_of + PRIOR - b, 0.5))
    return odds, np.sqrt(1 / a + 1 / b)


def decay(weights: np.ndarray, share: np.ndarray, drift: float) -> float:
    """The positive root lambda of E[exp(lambda * score)] = 1 by bisection."""
    def excess(rate: float) -> float:
        return float(share @ np.expm1(rate * weights) + (1 - share.sum()) * math.expm1(rate * drift))

    low, high = 0.0, 1e-3
    while excess(high) < 0 and high * weights.max() < 500:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _curve(bins: list[tuple[int, float, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve over (label, x, count), by Newton's method with a ridge."""
    y, x, n = (np.array(c, float) for c in zip(*bins, strict=True))
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2), design.T @ (n * (y - p)) - 1e-2 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def _markers(train: DataFrame, docs: DataFrame, toxic: int, clean: int) -> tuple[Model, dict[str, int]]:
    """The words with enough log-odds, uncalibrated, and the tokens of both classes."""
    path = shared_folder(train.sparkSession, "toxic-words")
    spark = train.sparkSession
    _class_counts(train).write.parquet(path)
    counted = spark.read.parquet(path)
    total = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS)).first().asDict()
    ahead = (F.col("toxic_texts") + 0.5) * (clean + 1) / ((F.col("clean_texts") + 0.5) * (toxic + 1))
    rows = counted.where((F.col("toxic_texts") >= LEAST_TEXTS) & (ahead >= math.exp(LEAST_ODDS)) & (F.length("word") <= LONGEST)).orderBy(
        F.desc(ahead * F.sqrt("toxic_texts")), "word").limit(MAX_TERMS).collect()
    delete(spark, path)
    words = sorted(bytes(r["word"]) for r in rows)
    if not words:
        return Model([], np.zeros(0)), total
    by_word = {bytes(r["word"]): r for r in rows}
    held, everything = _background(docs, words)
    count = lambda c: np.array([by_word[w][c] for w in words], float)
    share = np.array([(held.get(w, 0) + 0.5) / (everything + 1) for w in words])
    odds, spread = log_odds(count("toxic_texts"), toxic, count("clean_texts"), clean, share)
    bound = odds - BOUND * spread
    kept = bound >= LEAST_ODDS
    if not kept.any():
        return Model([], np.zeros(0)), total
    weights = bound[kept]
    # Shares of the markers among clean and toxic tokens give the drift of all others.
    usual = (count("clean_tokens")[kept] + 0.5) / (total["clean_tokens"] + 1)
    usual *= min(1.0, 0.4 / usual.sum())
    often = min(0.5, count("toxic_tokens")[kept].sum() / (total["toxic_tokens"] + 1))
    drift = min(math.log((1 - often) / (1 - usual.sum())), -2 * float(usual @ weights), -1e-6)
    model = Model([w for w, k in zip(words, kept, strict=True) if k], weights, drift, decay(weights, usual, drift))
    return model, total


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Learn markers, extreme-value parameters and the curve from at most ``rows`` labelled ids."""
    spark = docs.sparkSession
    path = shared_folder(spark, "toxic-train")
    _training_texts(docs, labels, label_col, id_col, text_col, rows).write.parquet(path)
    train = spark.read.parquet(path)
    sizes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        delete(spark, path)
        return Model([], np.zeros(0), offset=math.log((toxic + 1) / (clean + 1)))
    model, _ = _markers(train, keyed_text(docs, id_col, text_col).select("doc_id", "text"), toxic, clean)

    def best(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = tokens(batch.column(1))
        top = np.zeros(len(found.counts))
        for d, _, parts in model.segments_of(found):
            top[d] = max(s for s, _, _ in parts)
        return pa.RecordBatch.from_arrays([pa.array(found.counts), pa.array(found.counts * np.exp(-np.minimum(model.rate * top, 700)))], names=["n", "mass"])

    mass = map_arrow(train.where("label = 0"), best, "n bigint, mass double", SLICE).where("n > 0").agg(F.count("*").alias("k"), F.sum("mass").alias("s")).first()
    if mass["k"]:
        model.scale = mass["k"] / max(mass["s"], 1e-300)

    def sums(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.round(np.log1p(model.evidence(tokens(batch.column(1)))), 2)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x)], names=["label", "x"])

    bins = map_arrow(train, sums, "label int, x double", SLICE).groupBy("label", "x").count().orderBy("label", "x").collect()
    model.slope, model.offset = _curve([tuple(b) for b in bins])
    delete(spark, path)
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = sent.value.probability(sent.value.evidence(tokens(batch.column(1))))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    texts = keyed_text(docs, id_col, text_col)
    out = map_arrow(texts, work, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double", SLICE)
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per significant passage: ``doc_id``, ``start``, ``end`` (code points), ``passage``, ``points``, ``expected``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    texts = keyed_text(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                found = tokens(part.column(1))
                data, ends = bytes_of(part.column(1))
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                rows = []
                for d, base, segs in sent.value.segments_of(found):
                    for score, first, last in segs:
                        chance = sent.value.expected(score, int(found.counts[d]))
                        if chance <= CHANCE:
                            a, b = found.starts[base + first], found.ends[base + last]
                            rows.append((d, points[a] - points[ends[d]], points[b] - points[ends[d]], data[a:b].tobytes().decode(), score, chance))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                         pa.array(columns[3], pa.string()), pa.array(columns[4], pa.float64()), pa.array(columns[5], pa.float64())],
                        names=["doc_id", "start", "end", "passage", "points", "expected"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(work, f"doc_id {kind}, start bigint, end bigint, passage string, points double, expected double")
