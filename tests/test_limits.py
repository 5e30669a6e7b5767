"""Values of any length, device names, and operator tables read token by token."""

import json
import time

import pytest
from pyspark.sql import functions as F

from veil.operators import detect as D
from veil.operators.optable import operators_block, operators_map, without_trailing_commas


def found(spark, text):
    df = spark.createDataFrame([(1, 0, text)], "session_id bigint, turn bigint, text string")
    return {(r.operator, r.value) for r in D.detect(df).collect()}


@pytest.mark.parametrize("local", [64, 65, 70, 5000])
@pytest.mark.parametrize("labels", [1, 11, 100])
def test_addresses_of_any_length_are_found_whole(spark, local, labels):
    address = "a" * local + "@" + "b." * labels + "org"
    for text in (address, f"to {address}, now", f"...{address}."):
        assert ("EMAIL_ADDRESS", address) in found(spark, text)


def test_long_runs_are_read_once(spark):
    start = time.time()
    run = "aB9+" * 250_000
    assert found(spark, f"{run} x@y.org {run} @ " + "a@" * 100_000) == {("EMAIL_ADDRESS", "x@y.org")}
    digits = " ".join("7" * 500_000)
    assert found(spark, digits) == {("DEFAULT", digits)}
    assert time.time() - start < 60


def test_digits_written_apart_have_no_longest_length(spark):
    for n in (20, 30, 200):
        digits = "-".join("1234567890"[k % 10] for k in range(n))
        assert found(spark, f"it is {digits} ok") == {("DEFAULT", digits)}
    card, wrong = " ".join("4111111111111111"), " ".join("4111111111111112")
    assert found(spark, card) == {("CREDIT_CARD_NUMBER", card)}
    assert found(spark, wrong) == {("DEFAULT", wrong)}


@pytest.mark.parametrize("name,masked", [
    ("Anna Light", True), ("Zoe Lamp", True), ("Camera", False), ("My Kitchen Light", False),
    ("The Front Door", False), ("Living Room Lights", False), ("Kitchen", True),
])
def test_only_rooms_and_articles_make_a_device_name(spark, name, masked):
    assert (("PERSON", name) in found(spark, f"This is {name}.")) == masked


TABLE = '{"A": {"type": "replace", "new_value": "[A]"},}'


@pytest.mark.parametrize("prompt,block", [
    (f"x OPERATORS = {TABLE}\n\nrest", TABLE + "\n\n"),
    (f"OPERATORS={TABLE}  \n \t\n  rest", TABLE + "  \n \t\n"),
    (f"OPERATORS\n=\n{TABLE}\r\n\r\nrest", TABLE + "\r\n\r\n"),
    (f"OPERATORS = {TABLE}\n\nmore }}\n\n\nrest {{x}}", TABLE + "\n\nmore }\n\n\n"),
    (f"OPERATORS = {TABLE}\nrest", None), ("OPERATORS = {", None), ("} \n\n OPERATORS = {x", None),
    ("no table", None), ("", None), (None, None),
])
def test_where_a_block_ends(spark, prompt, block):
    df = spark.createDataFrame([(prompt,)], "prompt string")
    assert df.select(operators_block(F.col("prompt")).alias("b")).first()["b"] == block


def test_commas_inside_strings_stay(spark):
    cases = ['{"a": "x,}", }', '{"a": "q\\",}", "b": [1, 2],\n}', '{"a": {"b": 1,},}', "{}", '{"long": "' + "y, }" * 50_000 + '",}']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [json.loads(r["t"]) for r in df.select("i", without_trailing_commas(F.col("t")).alias("t")).orderBy("i").collect()]
    assert got == [{"a": "x,}"}, {"a": 'q",}', "b": [1, 2]}, {"a": {"b": 1}}, {}, {"long": "y, }" * 50_000}]


def test_unreadable_tables_are_null(spark):
    prompts = ['OPERATORS = {"A": {"type": "replace\n}\n\n', "OPERATORS = {A B}\n\n"]
    df = spark.createDataFrame([(p,) for p in prompts], "prompt string")
    assert [r["m"] for r in df.select(operators_map(F.col("prompt")).alias("m")).collect()] == [None, None]
