"""Calls of a model: spread over tasks, one bad text at a time."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from veil.operators import model as M
from veil.operators.gazetteer import match_terms

# Tasks cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def body(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def test_one_bad_text_costs_no_other_its_answer(spark):
    def factory():
        def detector(group, prompt, model):
            if any("bad" in t for t in group):
                raise ValueError("refused")
            return [body(t) for t in group]
        return detector

    got = M.ask(texts(spark, ["bad", *(f"good {k}" for k in range(60))]), factory, "p", "m", tasks=2).collect()
    assert {r.text for r in got if r.response is None} == {"bad"}
    assert all(r.attempts == 3 for r in got if r.text == "bad") and all(r.attempts <= 2 for r in got if r.text != "bad")


def test_what_counts_as_a_failed_answer(spark):
    answers = {"a": (200, body("a")), "b": (503, body("b")), "c": "no json", "d": None, "e": body("e"), "f": (204, "")}

    def factory():
        return lambda group, prompt, model: [answers[t] for t in group]

    got = {r.text: r.response for r in M.ask(texts(spark, answers), factory, "p", "m", texts_per_call=4).collect()}
    assert got == {"a": body("a"), "b": None, "c": None, "d": None, "e": body("e"), "f": None}


def test_a_wrong_number_of_answers_is_a_failure(spark):
    def factory():
        return lambda group, prompt, model: [body("x")] if len(group) == 1 else [body("x")] * (len(group) + 1)

    got = M.ask(texts(spark, [f"t{k}" for k in range(10)]), factory, "p", "m").collect()
    assert all(r.response == body("x") for r in got)


def test_calls_are_spread_over_tasks_even_for_few_texts(spark):
    def factory():
        from pyspark import TaskContext

        return lambda group, prompt, model: [json.dumps(TaskContext.get().partitionId()) for _ in group]

    got = M.answers(texts(spark, [f"text {k}" for k in range(400)] * 2), factory, "p", "m")
    assert got.count() == 400 and got.select("response").distinct().count() >= 16


def test_rows_without_text_keep_a_place(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "k int, text string")
    found = M.keyed(texts(spark, ["a"])).select("text_key", "text", F.lit("r").alias("response"))
    assert sorted((r.k, r.response) for r in M.with_answers(rows, found).collect()) == [(1, "r"), (2, None), (3, "r")]


def test_the_memo_is_bounded_by_time_alone(spark):
    now = F.lit("2024-05-01 12:00:00").cast("timestamp")
    memo = spark.range(1500).select(F.col("id").cast("string").alias("text_key"), (now - F.expr("INTERVAL 5 MINUTES")).alias("responded_at"))
    assert M.live_memo(memo, now).count() == 1500 and M.live_memo(memo, now, entries=10).count() == 10


def test_terms_of_any_length_and_case(spark):
    turns = spark.createDataFrame([(1, "met Anna Maria Luisa von Hohenfels today, she has chronic asthma now")], "session_id int, text string")
    terms = spark.createDataFrame([("Anna Maria Luisa von Hohenfels", "PERSON"), ("chronic asthma", "DEFAULT"), ("asthma attack", "DEFAULT")], "term string, operator string")
    assert {r.value for r in match_terms(turns, terms).collect()} == {"Anna Maria Luisa von Hohenfels", "chronic asthma"}
