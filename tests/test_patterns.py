"""Patterns of the rules in the form in which they run, and what the actions run."""

import re
import time

import pytest
from pyspark.sql import functions as F

from checks import detection, rewriting
from veil.functions.jsontext import DEPTH
from veil.operators import detect as D
from veil.operators.rewrite import mask_arguments
from veil.operators.rules import RULES, SHARED, SPACED_RULES

_CLASS = re.compile(r"\\.|\[(?:\\.|[^\]\\])*\]")


def classes(pattern):
    return [m for m in _CLASS.findall(pattern) if m.startswith("[")]


@pytest.mark.parametrize("pattern", sorted(
    {p for r in RULES + SPACED_RULES for p in (r.pattern, r.hint) if p} | {h for *_, h in SHARED}))
def test_classes_without_ranges_hold_the_same_characters(pattern):
    quick = D.spelled_classes(pattern)
    assert not [c for c in classes(quick) if re.search("[0-9A-Za-z]-[0-9A-Za-z]", c)]
    assert _CLASS.sub("", quick) == _CLASS.sub("", pattern)
    for given, made in zip(classes(pattern), classes(quick), strict=True):
        if "\\p" not in given:
            assert all(bool(re.fullmatch(given, chr(i))) == bool(re.fullmatch(made, chr(i))) for i in range(0x250)), given


def test_what_is_no_range_stays():
    assert D.spelled_classes(r"a-c[\]a-c-][^x-z_-]\[0-9") == r"a-c[\]abc-][^xyz_-]\[0-9"


def test_an_action_runs_the_rules_of_its_operators_only(spark):
    """The plan of one operator holds no pattern of others; before, all were run and then dropped."""
    made = detection.QUERIES["act_mask"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "swift|bic" not in plan and "routing|aba" not in plan


def test_arguments_with_strings_and_pairs_in_number(spark):
    """Pairs are looked up once per arguments, not once per string of them."""
    text = "[" + ",".join(f'"s{i}"' for i in range(100_000)) + ',"v7 and \\u0076", 5]'
    df = spark.createDataFrame([(text, [(f"v{i}", "[X]") for i in range(2_000)])],
                               "t string, p array<struct<value string, replacement string>>")
    start = time.time()
    out = df.select(mask_arguments(F.col("t"), F.col("p")).alias("m")).first()["m"]
    assert out == text.replace("v7 and \\u0076", "[X] and v")
    assert time.time() - start < 8


def test_arguments_are_read_once(spark):
    """The strings of arguments go through the reader once, for looking and for rewriting; before, once for each."""
    df = spark.createDataFrame([('{"q":"v"}', [("v", "[X]")])], "t string, p array<struct<value string, replacement string>>")
    plan = df.select(mask_arguments(F.col("t"), F.col("p")).alias("m"))._jdf.queryExecution().analyzed().toString()
    nested = 2 * DEPTH  # strings inside strings are few and read where they are
    assert plan.count("from_json(") == 1 + nested


def test_spellings_are_made_once(spark):
    """The spellings of a text are a column before they are rows; before, the generator made each part again for every use."""
    plan = rewriting.QUERIES["mask_spellings"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(spelled" in plan and "explode(array(struct(spelling" not in plan
