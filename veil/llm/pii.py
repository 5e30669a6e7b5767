"""Personal data by rules and by a linear-chain conditional random field.

The rules find emails, IP addresses, payment cards and phone numbers, leftmost and
without overlap within a kind; a match that fails its check is dropped and not retried.
The field reads word shapes: the shape of a word and of its neighbours, digit counts and
check digits. Its labels are O, and B and I of each kind. It is trained by gradient ascent on
the likelihood of a small labelled table (at most ``TRAIN_ROWS`` rows, the rules being
the teacher unless the caller has labels), and decoded by Viterbi in numpy, many runs at
once. Words without a digit, ``@`` or ``+`` are O by definition, so runs of the other
words are decoded, exactly, between them. Spans of the field that touch a span of
the rules are dropped: those stay as they are.

Results: a null text counts as empty and has no spans. Offsets are code points, ends
exclusive. Rows may repeat, each is read alike. A table without any labelled words
trains no field; the rules then stand alone. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import bytes_of, keyed_text, slices

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Rows, picked by the hash of their ids, whose labels train the field.
TRAIN_ROWS = 20_000
ROUNDS, RATE, PENALTY = 120, 0.5, 0.02
#: Most distinct runs, words of a run and characters of a word that training takes.
TRAIN_RUNS, TRAIN_WORDS, TRAIN_LENGTH = 5000, 48, 256

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Written so that no text takes more than linear time: possessive digits, and a start
# only where a run of digits starts.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all kinds, by start and then kind as listed."""
    out: list[tuple[str, int, int]] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            end = m.end()
        else:
            end = max(end, start)
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def shape(word: str) -> str:
    """Letters as X or x, digits as d, other characters as themselves."""
    return "".join("d" if c.isdecimal() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word[:40])


def folded(shape_: str) -> str:
    """A shape with runs of one class written once."""
    return re.sub(r"(.)\1+", r"\1", shape_)[:12]


def word_features(word: str, before: str, after: str) -> list[str]:
    own = shape(word)
    digits = _digits(word)
    out = ["one", "s=" + own, "f=" + folded(own), f"n={min(len(digits), 20)}", "p=" + folded(shape(before)), "q=" + folded(shape(after))]
    if 14 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    octets = word.strip(".,;:()").split(".")
    if len(octets) == 4:
        out.append(f"ip={all(o.isdecimal() and len(o) <= 3 and int(o) <= 255 for o in octets)}")
    return out


@dataclass
class Run:
    """Neighbouring words that may carry a label, with the words around them."""

    doc: int
    words: list[str]
    starts: list[int]  # code points
    before: str
    after: str


_MAY = np.zeros(256, bool)
_MAY[[*range(48, 58), ord("@"), ord("+")]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def runs_of(texts: pa.Array) -> list[Run]:
    """All runs of words with a digit, ``@`` or ``+``; nothing is done for other words."""
    data, ends = bytes_of(texts)
    hits = np.flatnonzero(_MAY[data]) if len(data) else np.zeros(0, np.int64)
    if not len(hits):
        return []
    ink = ~_SPACE[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edges = ends[(ends > 0) & (ends < len(data))]
    first[edges] = ink[edges]
    starts = np.flatnonzero(first)
    gap = ~ink
    last = np.flatnonzero(np.concatenate((ink[:-1] & (gap[1:] | first[1:]), ink[-1:]))) + 1
    chosen = np.unique(np.searchsorted(starts, hits, side="right") - 1)
    doc = np.searchsorted(ends, starts[chosen], side="right") - 1
    cut = np.flatnonzero((np.diff(chosen) != 1) | (np.diff(doc) != 0)) + 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    raw = data.tobytes()
    word = lambda k: raw[starts[k] : last[k]].decode()
    out = []
    for group in np.split(np.arange(len(chosen)), cut):
        d, a, b = int(doc[group[0]]), int(chosen[group[0]]), int(chosen[group[-1]])
        base = points[ends[d]]
        out.append(Run(
            d, [word(k) for k in range(a, b + 1)], [int(points[starts[k]] - base) for k in range(a, b + 1)],
            word(a - 1) if a and starts[a - 1] >= ends[d] else "", word(b + 1) if b + 1 < len(starts) and starts[b + 1] < ends[d + 1] else "",
        ))
    return out


def taught_labels(run: Run, spans: list[tuple[str, int, int]]) -> list[int]:
    """Labels of a run under spans; the kind listed first wins where spans overlap."""
    out = []
    for word, start in zip(run.words, run.starts, strict=True):
        label = 0
        for kind, a, b in sorted(spans, key=lambda s: KINDS.index(s[0])):
            if a < start + len(word) and b > start:
                label = LABELS.index(("B-" if a >= start else "I-") + kind)
                break
        out.append(label)
    return out


class Field:
    """Weights of the features and of the transitions between labels."""

    def __init__(self, features: dict[str, int]):
        self.features = features
        self.emit = np.zeros((len(features) + 1, len(LABELS)))  # the last row is for unknown features
        # Row 0 of the transitions: from and to O, which stands at both ends of a run.
        self.step = np.zeros((len(LABELS), len(LABELS)))

    def lookup(self, run: Run) -> list[list[int]]:
        words = [run.before, *run.words, run.after]
        unknown = len(self.features)
        return [[self.features.get(f, unknown) for f in word_features(words[k], words[k - 1], words[k + 1])] for k in range(1, len(words) - 1)]

    def emissions(self, runs: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (run, place, label), padded, and the mask of real places."""
        longest = max(map(len, runs))
        out = np.zeros((len(runs), longest, len(LABELS)))
        mask = np.zeros((len(runs), longest), bool)
        for r, run in enumerate(runs):
            mask[r, : len(run)] = True
            for k, ids in enumerate(run):
                out[r, k] = self.emit[ids].sum(0)
        return out, mask

    def viterbi(self, runs: list[list[list[int]]]) -> list[np.ndarray]:
        """Best labels of each run; runs of similar length are decoded together."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(runs)
        order = sorted(range(len(runs)), key=lambda r: len(runs[r]))
        at = 0
        while at < len(order):
            size = len(runs[order[at]])
            upto = at
            while upto < len(order) and len(runs[order[upto]]) <= 2 * size and (upto - at) * size < 100_000:
                upto += 1
            part = order[at:upto]
            for r, labels in zip(part, self._decode(*self.emissions([runs[r] for r in part])), strict=True):
                out[r] = labels
            at = upto
        return out

    def _decode(self, emit: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
        n, longest, _ = emit.shape
        best = emit[:, 0] + self.step[0]
        came = np.zeros(emit.shape, np.int8)
        for k in range(1, longest):
            through = best[:, :, None] + self.step[None]
            came[:, k] = through.argmax(1)
            best = np.where(mask[:, k, None], through.max(1) + emit[:, k], best)
        now = (best + self.step[:, 0]).argmax(1)
        size = mask.sum(1)
        labels = np.zeros((n, longest), int)
        for k in range(longest - 1, -1, -1):
            here = k < size
            labels[here, k] = now[here]
            if k:
                back = here & (k < size)
                now = np.where(back, came[np.arange(n), k, now], now)
        return [labels[r, : size[r]] for r in range(n)]

    def fit(self, runs: list[list[list[int]]], labels: list[list[int]], rounds: int = ROUNDS) -> None:
        """Adaptive gradient ascent on the penalised log-likelihood of all runs."""
        longest, n, size = max(map(len, runs)), len(runs), len(LABELS)
        width = max(len(f) for run in runs for f in run)
        none = len(self.features) + 1
        ids = np.full((n, longest, width), none)
        gold = np.zeros((n, longest), int)
        mask = np.zeros((n, longest), bool)
        for r, (run, own) in enumerate(zip(runs, labels, strict=True)):
            mask[r, : len(run)] = True
            gold[r, : len(own)] = own
            for k, f in enumerate(run):
                ids[r, k, : len(f)] = f
        flat = ids[mask]
        end = mask.sum(1) - 1
        rows = np.arange(n)
        seen_emit = np.zeros((none + 1, size))
        np.add.at(seen_emit, flat.ravel(), np.repeat(np.eye(size)[gold[mask]], width, axis=0))
        seen_step = np.zeros((size, size))
        np.add.at(seen_step, (0, gold[:, 0]), 1)
        np.add.at(seen_step, (gold[rows, end], 0), 1)
        pairs = mask[:, 1:]
        np.add.at(seen_step, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
        sum_emit, sum_step = np.full((none + 1, size), 1e-8), np.full((size, size), 1e-8)
        emit = np.zeros((none + 1, size))
        for _ in range(rounds):
            score = np.zeros((n, longest, size))
            score[mask] = emit[flat].sum(1)
            step = self.step
            alpha = np.zeros((n, longest, size))
            beta = np.zeros((n, longest, size))
            alpha[:, 0] = step[0] + score[:, 0]
            for k in range(1, longest):
                alpha[:, k] = np.where(mask[:, k, None], _logsum(alpha[:, k - 1, :, None] + step, 1) + score[:, k], alpha[:, k - 1])
            total = _logsum(alpha[:, -1] + step[:, 0], 1)
            beta[rows, end] = step[:, 0]
            for k in range(longest - 2, -1, -1):
                inner = _logsum(step[None] + (score[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
                beta[:, k] = np.where(mask[:, k + 1, None], inner, beta[:, k])
            share = np.exp(alpha + beta - total[:, None, None])
            want_emit = np.zeros((none + 1, size))
            np.add.at(want_emit, flat.ravel(), np.repeat(share[mask], width, axis=0))
            want_step = np.zeros((size, size))
            want_step[0] += share[:, 0].sum(0)
            want_step[:, 0] += share[rows, end].sum(0)
            for k in range(1, longest):
                on = mask[:, k]
                if on.any():
                    two = alpha[on, k - 1, :, None] + step + (score[on, k] + beta[on, k])[:, None, :] - total[on, None, None]
                    want_step += np.exp(two).sum(0)
            for value, got, want, past in ((emit, seen_emit, want_emit, sum_emit), (self.step, seen_step, want_step, sum_step)):
                slope = got - want - PENALTY * value
                past += slope * slope
                value += RATE * slope / np.sqrt(past)
            emit[none] = 0
        self.emit = emit[:none]
        self.emit[-1] = 0


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def field_spans(run: Run, labels: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Spans of the labels of a run, without punctuation around them."""
    k = 0
    while k < len(labels):
        if not labels[k]:
            k += 1
            continue
        kind = LABELS[labels[k]][2:]
        last = k
        while last + 1 < len(labels) and LABELS[labels[last + 1]] == "I-" + kind:
            last += 1
        head, tail = run.words[k], run.words[last]
        start = run.starts[k] + len(head) - len(head.lstrip(".,;:!?\"'<>[]{}"))
        end = run.starts[last] + len(tail.rstrip(".,;:!?\"'<>[]{}"))
        if start < end:
            yield kind, start, end
        k = last + 1


def train(runs: list[tuple[Run, list[int]]]) -> Field | None:
    """A field from labelled runs; None without any label to learn."""
    if not any(any(y) for _, y in runs):
        return None
    known: dict[str, int] = {}
    for run, _ in runs:
        words = [run.before, *run.words, run.after]
        for k in range(1, len(words) - 1):
            for f in word_features(words[k], words[k - 1], words[k + 1]):
                known.setdefault(f, len(known))
    field = Field(known)
    field.fit([field.lookup(r) for r, _ in runs], [y for _, y in runs])
    return field


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, runs: int = TRAIN_RUNS) -> Field | None:
    """Train on at most ``runs`` distinct runs of the texts of ``rows`` ids, labelled by the rules.

    For training a run is cut every ``TRAIN_WORDS`` words, and runs with a word of more than
    ``TRAIN_LENGTH`` characters are left out, so what comes to the driver is bounded whatever
    the texts or repeated ids.
    """
    texts = keyed_text(docs, id_col, text_col)
    picked = texts.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                spans: dict[int, list] = {}
                rows_ = []
                for run in runs_of(part.column(1)):
                    if run.doc not in spans:
                        spans[run.doc] = rule_spans(part.column(1)[run.doc].as_py())
                    rows_ += [
                        {"words": piece.words, "starts": piece.starts, "before": piece.before, "after": piece.after, "labels": taught_labels(piece, spans[run.doc])}
                        for piece in _pieces(run) if max(map(len, (piece.before, piece.after, *piece.words))) <= TRAIN_LENGTH]
                    if len(rows_) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows_, schema=kind)
                        rows_ = []
                if rows_:
                    yield pa.RecordBatch.from_pylist(rows_, schema=kind)

    kind = pa.schema([("words", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())), ("before", pa.string()), ("after", pa.string()), ("labels", pa.list_(pa.int64()))])
    # Of equal runs the first by place and labels stands for all, so that training is repeatable.
    found = texts.join(F.broadcast(picked), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        work, "words array<string>, starts array<bigint>, before string, after string, labels array<bigint>")
    distinct = found.groupBy("words", "before", "after").agg(F.min(F.struct("starts", "labels")).alias("first"))
    got = distinct.select("words", "first.starts", "before", "after", "first.labels").orderBy(
        F.xxhash64("words", "before", "after"), "words", "before", "after").limit(runs).toArrow().to_pylist()
    got.sort(key=lambda r: (r["words"], r["before"], r["after"]))
    return train([(Run(0, r["words"], r["starts"], r["before"], r["after"]), r["labels"]) for r in got])


def _pieces(run: Run) -> Iterator[Run]:
    """The run in pieces of at most ``TRAIN_WORDS`` words."""
    words = run.words
    for a in range(0, len(words), TRAIN_WORDS):
        b = min(a + TRAIN_WORDS, len(words))
        yield Run(run.doc, words[a:b], run.starts[a:b], words[a - 1] if a else run.before, words[b] if b < len(words) else run.after)


def spans_of(texts: pa.Array, field: Field | None) -> list[tuple[list, list]]:
    """Of every text the spans of the rules, and all spans."""
    runs = runs_of(texts)
    rules: dict[int, list] = {}
    for run in runs:
        if run.doc not in rules:
            rules[run.doc] = rule_spans(texts[run.doc].as_py())
    more: dict[int, list] = {}
    if field is not None and runs:
        for run, labels in zip(runs, field.viterbi([field.lookup(r) for r in runs]), strict=True):
            if labels.any():
                base = rules[run.doc]
                more.setdefault(run.doc, []).extend(
                    s for s in field_spans(run, labels) if not any(a < s[2] and b > s[1] for _, a, b in base))
    out = []
    for d in range(len(texts)):
        base = rules.get(d, [])
        extra = more.get(d)
        out.append((base, sorted({*base, *extra}, key=lambda s: (s[1], KINDS.index(s[0]))) if extra else base))
    return out


def find_spans(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of kind, start, end) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    texts = keyed_text(docs, id_col, text_col)
    one = "array<struct<kind:string,start:bigint,end:bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        for batch in batches:
            for part in slices(batch):
                found = spans_of(part.column(1), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([named(b) for b, _ in found], kind), pa.array([named(s) for _, s in found], kind)], names=["doc_id", "base", "spans"])

    return texts.mapInArrow(work, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, base {one}, spans {one}")


def mask_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span as its kind in brackets; spans that overlap become one, named by the first."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of its text masked; other columns, and null texts, stay."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    others = [c for c in docs.columns if c != text_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.set_column(batch.num_columns - 1, "text", batch.column(batch.num_columns - 1).cast(pa.string()))):
                texts = part.column(part.num_columns - 1)
                filled = texts.fill_null("")
                found = spans_of(filled, sent.value)
                if any(s for _, s in found):
                    texts = pa.array([t if t is None or not s else mask_text(t, s) for t, (_, s) in zip(texts.to_pylist(), found, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=[*others, text_col])

    ordered = docs.select(*others, text_col)
    return ordered.mapInArrow(work, ordered.schema).select(*docs.columns)
