"""Text compression against a direct computation."""

import pytest

from checks.transcripts import brevity_text
from veil.operators.brevity import with_brief_text

TEXTS = [
    "The cat, the dog and THE cat!", "", "   ", "1 1 a a 2x 2x", "one", "(x) x' 'x «x» ñ Ñ ñ\xa0ñ",
    "q1 question question q1 quiet quiet", "a\tb\nb\x0ba　a _b_ [b]", "it's it's --- --- é. É",
]


def brief(text):
    def trim(w):
        ok = [i for i, c in enumerate(w) if c.isalnum()]
        return w[ok[0]: ok[-1] + 1].lower() if ok else ""

    words = [w for w in map(trim, text.split()) if w]
    short, used = {}, {}
    for w in words:
        if w not in short and words.count(w) > 1 and not w[0] in "0123456789":
            used[w[0]] = used.get(w[0], 0) + 1
            short[w] = f"{w[0]}{used[w[0]]}"
    return " ".join(short.get(w, w) for w in words), [(a, w) for w, a in short.items()]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    return with_brief_text(df).orderBy("doc_id").collect()


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_brief_text(rows, i):
    want, dictionary = brief(TEXTS[i])
    assert rows[i]["brief"] == want
    assert [(d["abbr"], d["word"]) for d in rows[i]["dictionary"]] == dictionary


def test_the_text_alone_needs_no_sorted_words(spark, tmp_path):
    texts = [*TEXTS, " ".join(f"w{i * i % 997}" for i in range(20_000)), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = brevity_text(spark, str(tmp_path))
    assert {r["doc_id"]: r["brief"] for r in rows.collect()} == {i: t if t is None else brief(t)[0] for i, t in enumerate(texts)}
    assert "sort_array" not in rows._jdf.queryExecution().executedPlan().toString()
