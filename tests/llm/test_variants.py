import binascii
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, clashing, empty
from veil.llm import variants

UP, DOWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute(rows, garble):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(str.maketrans(UP, DOWN))
            h = binascii.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if garble and h % 97 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def found(df, garble):
    rows = variants.spelling_variants(df, garble=garble).select("word", "n", "n_near", "form", "form_n", "root").collect()
    return sorted(map(tuple, rows))


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for garble in (False, True):
        assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), garble) == brute(rows, garble)


def test_edits_at_every_place_and_chains(spark):
    base = ["aaaaa", "aaaaaa", "aabaa", "abcdef", "ÀÉÎÕÜ", "ÀÉÎÕÿ", "xbcdef", "abcdefg", "abdef", "bcdef", "abcdxe", "acbdef", "Abcdeé"]
    rows = [(k, " ".join([w] * (3 + 7 * (k % 4)))) for k, w in enumerate(base)]
    rows += [(100 + k, " ".join([w] * n)) for k, (w, n) in enumerate([("qwert", 3), ("qwerty", 6), ("qwertyu", 12), ("qwertyui", 30), ("qwxert", 6)])]
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"), False)
    assert got == brute(rows, False)
    assert {r[0]: r[5] for r in got}["qwert"] == "qwertyui"


def test_every_pair_is_found_once(spark):
    words = spark.sql("SELECT explode(array('aaaaaa', 'aaaaa', 'aaaba', 'aabaa', 'aaaab')) AS word, 3L AS n")
    pairs = [(r.x, r.y) for r in variants.near_pairs(words).collect()]
    names = [r.word for r in words.collect()]
    assert len(pairs) == len(set(map(frozenset, pairs))) == sum(one_edit(a, b) for a in names for b in names if a < b)


def test_a_key_holds_a_bounded_number_of_words(spark):
    """Words that differ in their last letters only meet under the keys without those."""
    words = spark.range(3000).select(F.concat(F.lit("common"), F.translate(F.lpad(F.col("id").cast("string"), 4, "0"), "0123456789", "abcdefghij")).alias("word"), F.lit(5).alias("n"))
    keys = variants._keys(words, "x", F.lit(0), F.length("word"))
    assert keys.groupBy("size", "gap", "key").count().agg(F.max("count")).first()[0] <= 100
    got = {frozenset((r.x, r.y)) for r in variants.near_pairs(words).collect()}
    assert len(got) == sum(one_edit(f"{a:04d}", f"{b:04d}") for a in range(3000) for b in range(a))


def test_awkward_rows(spark):
    rows = awkward(spark, [(8, "Straße straße STRASSE naïve naïve naïve"), (9, "naive naive naive")])
    want = brute([(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()], True)
    assert found(rows, True) == want
    assert found(empty(spark), True) == []
    assert variants.spelling_variants(clashing(spark.createDataFrame([(1, None)], "doc_id bigint, text string"))).count() == 0
