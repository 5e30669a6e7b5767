"""Values in JSON text, however the text spells them."""

import json
import random

import pytest
from pyspark.sql import functions as F

from veil.functions.jsontext import rewritten, spelled_out
from veil.operators.rewrite import mask_arguments

PAIRS = [("https://a.example/x", "[URL]"), ("José", "[PERSON]"), ('say "hi" Ann', "[DEFAULT]"), ("4111", "****"), ("C:\\user", "[DEFAULT]")]


def masked(spark, texts, pairs=PAIRS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(2)
    listed = F.array(*(F.struct(F.lit(v).alias("value"), F.lit(r).alias("replacement")) for v, r in pairs))
    return [r.m for r in df.select("i", mask_arguments(F.col("t"), listed).alias("m")).orderBy("i").collect()]


CASES = [
    (r'{"q":"https:\/\/a.example\/x"}', {"q": "[URL]"}),
    (r'{"q":"Jos\u00e9 in C:\\users"}', {"q": "[PERSON] in [DEFAULT]s"}),
    (r'{"q":"Jos\u00E9 \\u00e9"}', {"q": "[PERSON] \\u00e9"}),
    (r'{"q":"say \u0022hi\u0022 Ann"}', {"q": "[DEFAULT]"}),
    (r'{"q":"say \"hi\" \u0041nn","José":["José"]}', {"q": "[DEFAULT]", "[PERSON]": ["[PERSON]"]}),
    (json.dumps({"a": json.dumps({"b": json.dumps({"c": "José"})})}), {"a": json.dumps({"b": json.dumps({"c": "[PERSON]"}, separators=(",", ":")).replace('", "', '","')})}),
    ('{"n":4111,"m":[14111, 5,4111],"k":true}', {"n": "****", "m": ["1****", 5, "****"], "k": True}),
    ('{"q":"nothing \\/ here \\u0041"}', {"q": "nothing / here A"}),
    ("[]", []), ('"José"', "[PERSON]"), ("4111", "****"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_every_spelling_is_masked(spark, k):
    text, want = CASES[k]
    got = json.loads(masked(spark, [text])[0])
    deep = lambda x: json.dumps(x).replace(" ", "") if k == 5 else x
    assert deep(got) == deep(want)


def test_what_does_not_change_stays_as_it_is_written(spark):
    texts = [r'{ "a" : "\u0041\/b\\u00e9\n" , "b":[1.50,-2e3, null] }', '{"s":"\\ud83d\\ude00 \\ud800"}', '{"x":"a\\\\\\"b\\\\"}', "", "no json José", None]
    got = masked(spark, texts)
    assert got[:4] == texts[:4] and got[4] == "no json [PERSON]" and got[5] is None


def test_random_documents_equal_a_rewriting_of_the_parsed_value(spark):
    rng = random.Random(3)
    alphabet = ['"', "\\", "/", "é", "😀", "a", "b", "\n", "\t", " ", "u0041", "ab", "{", "[", "]", "}", ",", ":", "1"]
    pairs = [("ab", "[X]"), ('"', "''"), ("\\", "|"), ("é", "[E]")]

    def text():
        return "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))

    def spell(s):
        out = []
        for c in s:
            units = c.encode("utf-16-be")
            pick = rng.randrange(3)
            if pick == 0 or c in '"\\\n\t' and pick == 1:
                out.append("".join(f"\\u{units[i:i + 2].hex()}" for i in range(0, len(units), 2)))
            else:
                out.append(json.dumps(c, ensure_ascii=False)[1:-1])
        return '"' + "".join(out) + '"'

    def nested(value):
        try:
            json.loads(value)
            return value.strip()[:1] in '{["'
        except ValueError:
            return False

    ordered = sorted(pairs, key=lambda p: (-len(p[0]), p[0]))

    def once(s):
        out = s
        for v, r in ordered:
            out = out.replace(v, r) if v in s else out
        return out

    rows, want = [], []
    while len(rows) < 150:
        a, b = text(), text()
        if nested(a) or nested(b):
            continue
        rows.append(f'{{"k":{spell(a)},"l":[{spell(b)}]}}')
        want.append({"k": once(a), "l": [once(b)]})
    assert [json.loads(m) for m in masked(spark, rows, ordered)] == want


def test_detection_reads_what_strings_say(spark):
    df = spark.createDataFrame([(r'{"q":"mail \u0061@b.org\nnow","r":"{\"s\":\"x\\\/y\"}"}',)], "t string")
    assert df.select(spelled_out(F.col("t")).alias("s")).first().s == '{"q":"mail a@b.org\nnow","r":"{"s":"x/y"}"}'


def test_long_strings_with_many_escapes(spark):
    text = json.dumps({"q": 'line "x" \\ é\n' * 40_000 + "José"})
    assert json.loads(masked(spark, [text])[0])["q"] == json.loads(text)["q"][:-4] + "[PERSON]"


def test_numbers_are_changed_whole(spark):
    df = spark.createDataFrame([('{"a":12,"b":123,"c":-12,"d":[12]}',)], "t string")
    out = df.select(rewritten(F.col("t"), lambda x: F.when(x == "12", F.lit("x")).otherwise(x)).alias("m")).first().m
    assert json.loads(out) == {"a": "x", "b": 123, "c": -12, "d": ["x"]}
