"""Long form: the same result however the pairs of a session reach its turns."""

import random

import pytest
from pyspark.sql import functions as F

from veil.operators import detect as D
from veil.operators import rewrite as W


def fold(text, pairs):
    """What a text becomes: pairs that occur in it, longest first."""
    for value, new in sorted((p for p in pairs if p[0] in text), key=lambda p: (-len(p[0]), p[0])):
        text = text.replace(value, new)
    return text


@pytest.fixture(scope="module")
def crowd():
    """One session with most of the turns and pairs, and some small ones."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abc1 ") for _ in range(rng.randint(1, 14))) for _ in range(120)]
    turns = []
    for turn in range(300):
        turns.append((1, turn, "x".join(rng.choice(words) for _ in range(4))))
    for session in range(2, 12):
        for turn in range(3):
            turns.append((session, turn, " ".join(rng.choice(words) for _ in range(3))))
    pairs = [(1, w, f"<{i}>") for i, w in enumerate(sorted(set(words)))]
    pairs += [(s, w, "[A]") for s in range(2, 8) for w in sorted(set(words))[: s]]
    pairs += [(2, "", "[EMPTY]"), (3, "same", "same")]
    return turns, pairs


@pytest.mark.parametrize("max_pairs", [1000, 50, 3, 0])
def test_both_ways_agree_with_brute_force(spark, crowd, max_pairs):
    turns, pairs = crowd
    df = spark.createDataFrame(turns, "session_id bigint, turn bigint, text string")
    pf = spark.createDataFrame(pairs, "session_id bigint, value string, replacement string")
    got = {(r["session_id"], r["turn"]): (r["masked_text"], r["n_pairs"])
           for r in W.mask_turns(df, pf, max_pairs).collect()}
    usable = [p for p in pairs if p[1] and p[1] != p[2]]
    want = {}
    for s, t, text in turns:
        mine = [(v, r) for ps, v, r in usable if ps == s]
        want[s, t] = (fold(text, mine), sum(v in text for v, _ in mine))
    assert got == want


def test_no_group_holds_a_crowded_session(spark, crowd):
    turns, pairs = crowd
    df = spark.createDataFrame(turns, "session_id bigint, turn bigint, text string")
    pf = spark.createDataFrame(pairs, "session_id bigint, value string, replacement string")
    usable = pf.where("value <> ''").where("session_id = 1")
    blocks = df.select("session_id", W._block()).distinct()
    per_block = W.pairs_by_piece(df, blocks, usable)
    # 300 turns are five blocks; a block lists only pairs that its texts can hold.
    assert per_block.count() == 5
    anchored = per_block.select(F.max(F.size("pairs"))).first()[0]
    assert anchored <= usable.count()


def test_masking_twice_changes_nothing_more(spark):
    df = spark.createDataFrame(
        [(1, 0, "Mail bob@example.com or call +1 (415) 555-0000."), (1, 1, "bob@example.com again")],
        "session_id bigint, turn bigint, text string")
    once = W.mask_turns(df, D.detect(df)).select(
        "session_id", "turn", F.col("masked_text").alias("text"))
    texts = [r["text"] for r in once.orderBy("turn").collect()]
    assert texts == ["Mail bob@e********** or call +1 (415) 5**-****.".replace("bob@e**********", "bob@e" + "*" * 10),
                     "bob@e" + "*" * 10 + " again"]
    twice = W.mask_turns(once, D.detect(df)).orderBy("turn").collect()
    assert [r["masked_text"] for r in twice] == texts


def test_turns_without_number_are_masked_and_spread(spark):
    rows = [(1, None, f"text {k} of Ann Lee") for k in range(300)]
    turns = spark.createDataFrame(rows, "session_id bigint, turn int, text string")
    found = spark.createDataFrame([(1, "Ann Lee", "[PERSON]")], "session_id bigint, value string, replacement string")
    out = W.mask_turns(turns, found).collect()
    assert len(out) == 300 and all(r["masked_text"].endswith("of [PERSON]") for r in out)
    assert turns.select(W._block()).distinct().count() > 200
