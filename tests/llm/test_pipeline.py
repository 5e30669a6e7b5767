import corpus_pipeline
from veil.llm import pii, queries
from veil.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_run_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        seen.append(docs)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "pii", "packing"]
    assert all(d.columns == columns for d in seen[:-1])
    kept = [{r.doc_id: r for r in d.collect()} for d in seen[:-1]]
    assert all(set(b) <= set(a) for a, b in zip(kept, kept[1:], strict=False))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in texts if labels.get(i) == 1]
    assert sum(i in kept[1] for i in good) >= 0.97 * len(good)
    assert all(kept[1][i].text == texts[i] for i in kept[1])
    for r in kept[2].values():  # what is left of a text are lines of it
        assert set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n")) and r.n_chars == len(r.text)
    assert len({r.text for r in kept[3].values()}) == len(kept[3])
    assert not any(pii.rule_spans(r.text) for r in kept[4].values()) and set(kept[4]) == set(kept[3])
    rows = seen[-1].collect()
    assert {r.doc_id for r in rows} == set(kept[4])


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.length for r in rows if r.piece > 0} <= {1024}


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_take_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0
