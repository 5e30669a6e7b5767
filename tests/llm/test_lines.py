import random

from tests.llm.helpers import awkward, empty
from veil.llm import lines


def brute(rows, min_words):
    """Of each distinct (id, text): the text without lines inside runs that start earlier as well."""
    first, out = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        parts = text.split("\n")
        ink = [k for k, p in enumerate(parts) if p.split()]
        gone = set()
        for i in range(len(ink)):
            words = 0
            for j in range(i, len(ink)):
                words += len(parts[ink[j]].split())
                if words >= min_words:
                    run = tuple(parts[k] for k in ink[i : j + 1])
                    if run in first:
                        gone.update(ink[i : j + 1])
                    first.add(run)
        gone.update(b for a, z in zip(ink, ink[1:], strict=False) if {a, z} <= gone for b in range(a + 1, z))
        out[(doc, text)] = ("\n".join(p for k, p in enumerate(parts) if k not in gone), len(parts), len(gone))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(7)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 7))) for _ in range(12)] + ["", "  "]
    passage = [" ".join(rng.choice("tuvwxyz") for _ in range(4)) for _ in range(9)]
    rows = []
    for k in range(150):
        own = [rng.choice(pool) if rng.random() < 0.6 else f"own {k} {j}" for j in range(rng.randint(0, 25))]
        if rng.random() < 0.4:
            at, a = rng.randint(0, len(own)), rng.randint(0, 4)
            own[at:at] = passage[a : a + rng.randint(2, 5)]
        rows.append((k, "\n".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for min_words in (1, 10, 17):
        want = brute(rows, min_words)
        got = {(r.doc_id): (r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs, min_words).collect()}
        assert got == {k: v for (k, _), v in want.items()}


def test_awkward_rows(spark):
    line = "one two three four five"
    docs = awkward(spark, [(50, f"{line}\n\n{line}\nx"), (51, f"{line}\n{line}\ny"), (51, f"{line}\n{line}\ny")])
    got = lines.dedup_lines(docs, 10).collect()
    assert len(got) == docs.count() and set(got[0].asDict()) == {*docs.columns, "n_lines", "n_removed"}
    assert all(r.bucket == "clash" for r in got)
    of = {}
    for r in got:
        of.setdefault(r.doc_id, []).append((r.text, r.n_removed))
    assert of[2] == [(None, 0)] and of[3] == [("", 0)]
    assert of[6] == [("", 1)] and of[5][0][1] == 0  # the long line repeats
    assert of[50] == [(f"{line}\n\n{line}\nx", 0)]
    assert of[51] == [("y", 2), ("y", 2)]  # rows that repeat are one occurrence
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_a_line_without_end_keeps_its_first(spark):
    docs = spark.createDataFrame([(1, "\n".join(["a b"] * 300))], "doc_id bigint, text string")
    assert [(r.text, r.n_removed) for r in lines.dedup_lines(docs, 50).collect()] == [("a b", 299)]


def test_windows():
    numbers, found, ahead, behind = lines.line_windows("a b\n\nc d e\nf", 4)
    assert numbers == [0, 2, 3] and [len(x.split()) for x in found] == [2, 3, 1]
    assert ahead.tolist() == [2, 2, 0] and behind.tolist() == [0, 2, 2]
