"""Repair and validation of model responses."""

import json
import time

import pytest
from pyspark.sql import functions as F

from veil.operators import pairs as P
from veil.operators.optable import (
    operators_block, operators_table, read_keyed_prompts, read_prompts, valid_tags, write_prompts,
)

# Keys that stand in the place of the replacement: tags, and masked values with four
# plain characters in front and four stars at the end.
TURNED = ["[LOCATION]", "[]", "[x y]", "wxyz****", "wxyz*******", "4 9 ****", "äöüß****", "q-7.!? ****"]
# Keys that are values: brackets on one side, a star among the first four, too few stars.
STRAIGHT = [
    "harbour 12", "[open", "close]", "in[mid]dle", "*xyz****", "w*yz****", "wx*z****", "wxy*****",
    "7****", "wxyz***", "wxyz**** ", "äöü*****", "", "*****",
]


def test_orientation(spark):
    keys = [(k, True) for k in TURNED] + [(k, False) for k in STRAIGHT]
    df = spark.createDataFrame([([(k, "given") for k, _ in keys],)], "p array<struct<raw_key string, raw_value string>>")
    got = df.select(P.orient(F.col("p")).alias("p")).first()["p"]
    for (key, turned), pair in zip(keys, got, strict=True):
        want = ("given", key) if turned else (key, "given")
        assert (pair["value"], pair["replacement"]) == want, key


def pairs_of(spark, content, tags=None):
    body = json.dumps({"choices": [{"message": {"content": content}}]})
    df = spark.createDataFrame([(body,)], "response string")
    wanted = None if tags is None else F.array(*[F.lit(t) for t in tags])
    row = P.with_pairs(df, "response", wanted).first()
    return row["pair_status"], {p["value"]: p["replacement"] for p in row["pairs"]}


def test_unknown_tags_are_dropped_unless_there_is_no_table(spark):
    given = {f"value {k}": tag for k, tag in enumerate(["[KNOWN]", "[STRANGE]", "plain", "[half", "valu****"])}
    text = json.dumps({"redactions": given})
    assert pairs_of(spark, text, ["[KNOWN]"])[1] == {k: v for k, v in given.items() if v != "[STRANGE]"}
    assert pairs_of(spark, text)[1] == given


@pytest.mark.parametrize("content,status", [
    ("no object here", "unparsed"), ("```json\n{\"redactions\": {}}\n```", "unparsed"),
    ("{}", "unparsed"), ('{"redactions": 5}', "unparsed"), ('{"redactions": {}} more', "unparsed"),
    ('{"redactions": {}}', "none_found"), ('{"redactions": {"a": "a"}}', "none_found"),
    ('{"redactions": {"[PIN]": ""}}', "none_found"), (5, "no_content"), (None, "no_content"),
    ('{"redactions": {"a": "[X]", "a": "[Y]"}}', "found"),
])
def test_status(spark, content, status):
    assert pairs_of(spark, content)[0] == status


def test_of_repeated_keys_the_last_wins(spark):
    assert pairs_of(spark, '{"redactions": {"a": "[X]", "a": "[Y]", "b": 5}}')[1] == {"a": "[Y]"}


@pytest.mark.parametrize("body,content", [
    ('{"choices":[{"message":{"content":"four words of text"}}]}', "four words of text"),
    ('{"choices":[{"message":{}}]}', None), ("{}", None), ("", None), ("not-json", None),
    ('{"choices":[]}', None),
])
def test_content(spark, body, content):
    df = spark.createDataFrame([(body,)], "response string")
    assert df.select(P.first_content(F.col("response"))).first()[0] == content


TABLE = '{\n"DEFAULT": {"type": "replace", "new_value": "[REDACTED]"},\n"X": {"type": "mask"},\n}'


def test_tags_of_a_prompt(spark, tmp_path):
    texts = [f"Rules\nOPERATORS = {TABLE}\n\nmore", f"OPERATORS = {TABLE}\nmore", "no table"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, prompt string")
    got = df.select("i", valid_tags(F.col("prompt")).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [["[REDACTED]"], None, None]
    assert df.where(operators_block(F.col("prompt")).isNotNull()).count() == 1


def test_missing_prompt_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_prompts(spark, str(tmp_path / "none.txt")).count()


def test_names_longer_than_the_json_reader_takes(spark):
    """Names above 50,000 characters, with escapes, beside short, repeated and nested ones."""
    long = 'quoted "x\\ \n é' * 6000
    given = {"a": "[X]", long: "[Y]", "[PIN]": long + "!", "b": 5}
    text = json.dumps({"redactions": given})
    assert pairs_of(spark, text) == ("found", {"a": "[X]", long: "[Y]", long + "!": "[PIN]"})
    again = text[:-2] + ', "a": "[Z]", ' + json.dumps(long) + ': "[W]"}}'
    assert pairs_of(spark, again)[1] == {"a": "[Z]", long: "[W]", long + "!": "[PIN]"}
    assert pairs_of(spark, json.dumps({"redactions": {"a": "[X]"}, long: {long: 1}})) == ("found", {"a": "[X]"})


@pytest.mark.parametrize("broken", [
    '{"redactions": {"%s" "[X]"}}', '{"redactions": {"%s": "[X]"}} x', '{"redactions": {"%s\u0001": "[X]"}}',
    '{"redactions": {"%s\\q": "[X]"}}', '{"redactions": {"%s\n": "[X]"}}', '{"redactions": {%s: "[X]"}}',
])
def test_broken_text_with_a_long_name_stays_unread(spark, broken):
    assert pairs_of(spark, broken % ("n" * 60_000))[0] == "unparsed"


def test_prompts_of_equal_keys_come_back_from_files(spark, tmp_path):
    """Many prompts to a file: of one key, of none, with line breaks, and few files in all."""
    prompt = f"OPERATORS = {TABLE}\n\nmore"
    rows = spark.createDataFrame([(1, prompt), (1, prompt), (None, prompt), (3, "no table")] + [
        (k, prompt) for k in range(4, 104)], "k long, prompt string").coalesce(2)
    write_prompts(rows, str(tmp_path / "p"), ["k"])
    assert len(list((tmp_path / "p").glob("part-*"))) == 2
    read = read_keyed_prompts(spark, str(tmp_path / "p"), "k BIGINT")
    got = [r["k"] for r in operators_table(read, ["k"]).where("name = 'DEFAULT'").collect()]
    assert sorted(got, key=str) == sorted([1, 1, None, *range(4, 104)], key=str)


def test_a_table_of_many_operators_is_read_in_time(spark):
    """Every token is looked at once: 3000 operators took minutes when each token read the text again."""
    body = "".join(f'"N{i}": {{"type": "replace", "new_value": "[T{i}]"}},\n' for i in range(3000))
    df = spark.createDataFrame([("OPERATORS = {" + body + "}\n\nmore",)], "prompt string")
    start = time.time()
    assert len(df.select(valid_tags(F.col("prompt")).alias("t")).first()["t"]) == 3000
    assert time.time() - start < 20
