import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa

from tests.llm.helpers import awkward, empty
from veil.llm import pii


def plain(text):
    """The four kinds straight from their definitions."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        checked = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
        if 14 <= len(d) <= 19 and checked % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_rules_are_the_definitions():
    rng = random.Random(3)
    for k in range(20_000):
        letters = "123456789.+- 0(" if k % 3 == 0 else "ab1239.@+-_ ()% é4"
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        assert pii.rule_spans(text) == plain(text), text


def test_rules_take_linear_time():
    start = time.time()
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "@" * 200_000, "1 " * 100_000, "+" + "1(" * 100_000):
        pii.rule_spans(text)
    assert time.time() - start < 10


def taught():
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        phone = f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        mail = f"{rng.choice(['ann', 'bo', 'cy.d'])}.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com"
        rows += [f"call {phone} now", f"write to {mail} please", f"version {rng.randint(1, 9)}.0 of {rng.randint(1990, 2020)}", f"from {'.'.join(str(rng.randint(1, 255)) for _ in range(4))} on"]
    runs = []
    for text in rows:
        runs += [(r, pii.taught_labels(r, pii.rule_spans(text))) for r in pii.runs_of(pa.array([text]))]
    return pii.train(runs)


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    field = pii.Field({"a": 0, "b": 1, "c": 2})
    field.emit = rng.normal(size=(4, len(pii.LABELS)))
    field.step = rng.normal(size=(len(pii.LABELS),) * 2)
    runs = [[[int(x)] for x in rng.integers(0, 4, n)] for n in (1, 2, 3, 4, 4, 1)]
    for run, got in zip(runs, field.viterbi(runs), strict=True):
        def score(path, run=run):
            total = field.step[0, path[0]] + field.step[path[-1], 0] + sum(field.emit[f[0], y] for f, y in zip(run, path, strict=True))
            return total + sum(field.step[a, b] for a, b in itertools.pairwise(path))
        assert tuple(got) == max(itertools.product(range(len(pii.LABELS)), repeat=len(run)), key=score)


def test_field_adds_what_rules_miss_and_leaves_the_rest():
    field = taught()
    texts = ["reach me: +1 (555) 201-99", "version 3.0 of 2001", "plain words only", "mail ann.12@mail3.example.com, thanks", "host 300.1.2.3 no"]
    found = pii.spans_of(pa.array(texts), field)
    assert [s for s in found[0][1]] == [("phone", 10, 25)] and found[0][0] == []  # one digit short for the rule
    assert found[1] == ([], []) and found[2] == ([], [])
    assert found[3][0] == found[3][1] == [("email", 5, 29)]
    assert all(set(base) <= set(spans) for base, spans in found)


def test_mask():
    assert pii.mask_text("a x@y.z b 1.2.3.4", [("ip", 10, 17), ("email", 2, 7)]) == "a [EMAIL] b [IP]"
    assert pii.mask_text("0123456789", [("ip", 1, 4), ("card", 3, 6)]) == "0[IP]6789"


def test_tables(spark):
    docs = awkward(spark, [(40, "é a@b.cd 4202965827824311"), (41, "1.2.3.4 a@b.cd")])
    field = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find_spans(docs, field).collect()}
    assert [tuple(s) for s in got[40].base] == [("email", 2, 8), ("card", 9, 25)]
    assert got[2].base == [] and len(got) == 10
    masked = {r.doc_id: r for r in pii.mask(docs, field).collect()}
    assert masked[40].text == "é [EMAIL] [CARD]" and masked[2].text is None and masked[40].bucket == "clash"
    assert pii.mask(docs, field).columns == docs.columns
    none = pii.fit(empty(spark))
    assert none is None and pii.find_spans(empty(spark), none).count() == 0
    assert [s.kind for s in pii.find_spans(docs, None).where("doc_id = 41").first().base] == ["ip", "email"]


def test_training_takes_bounded_runs(spark, monkeypatch):
    """One text of half a million runs and an id on a third of the rows do not come to the driver whole."""
    from pyspark.sql import functions as F

    seen = []
    monkeypatch.setattr(pii, "train", lambda runs: seen.append(runs))
    docs = spark.range(90).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") == 4, F.array_join(F.transform(F.sequence(F.lit(1), F.lit(500_000)), lambda k: F.concat(k.cast("string"), F.lit(" and"))), " "))
        .when(F.col("id") == 5, F.repeat(F.lit("12 "), 10_000)).when(F.col("id") == 7, F.repeat(F.lit("1"), 5000))
        .otherwise(F.concat(F.lit("call +49 30 1234567 or a@b.org now "), "id")).alias("text"))
    pii.fit(docs)
    runs = [r for r, _ in seen[0]]
    assert len(runs) == pii.TRAIN_RUNS
    assert max(len(r.words) for r in runs) <= pii.TRAIN_WORDS
    assert max(len(w) for r in runs for w in r.words) <= pii.TRAIN_LENGTH
