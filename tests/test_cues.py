"""Detection reads only lines with a digit or a cue; it must find what it finds in whole texts."""

import random
import re

import pytest

from veil.operators import detect as D
from veil.operators.rules import RULES

FOUND = {
    "EMAIL_ADDRESS": ["to ann@example.org now", "a" * 70 + "@example.org"],
    "URL": ["see HTTPS://x.example/a", "Www.example.org", "s3://bucket/key"],
    "SWIFT_CODE": ["SWIFT code: DEUTDEFF", "bic is CHASUSXX", "BIC: CHASUSXX", "bic CHASUSXX", "bicCHASUSXX", "Swift:DEUTDEFF"],
    "PERSON": ["My name is Zoé", "this is Élan Vital", "Mr Smith", "Mrs. Smith", "Ms Smith", "Dr. Who", "I am Li Wei", "I'm Li Wei"],
    "LOCATION": ["live in Rome", "living in Rome", "located in Ålesund", "moved to Rome", "travel to Rome"],
    "DEFAULT": ["token=abcdefghijklmnop", "SECRET : abcdefghijklmnop", "api_key: \"abcdefghijklmnop", "username is ann_b",
                "User name: ann_b", "user id=ann_b", "account id is ann_b"],
}


def hits(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows, scan = D.scanned(df)
    return {r["i"]: sorted((h["operator"], h["value"]) for h in r["h"]) for r in rows.select("i", D.candidates(scan).alias("h")).collect()}


@pytest.mark.parametrize("operator", sorted({r.operator for r in RULES if not r.digits}))
def test_every_cue_is_kept(spark, operator):
    for text, found in zip(FOUND[operator], hits(spark, FOUND[operator]).values()):
        assert operator in {name for name, _ in found}, text


def test_lines_without_cues_change_nothing(spark, monkeypatch):
    pieces = [t for ts in FOUND.values() for t in ts] + [
        "\n", "\n", " ", ".", "plain words", "éü", "1", "4111 1111 1111 1111", "call 555-123 4567", "pin 1234", "\r", "token", "=", ": ", "Rome", "is "]
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(600)]
    kept = hits(spark, texts)
    monkeypatch.setattr(D, "CUED", "(?s).|^$")
    assert kept == hits(spark, texts)
    assert any("\n" in t and not re.search("[0-9@]", t) and kept[i] for i, t in enumerate(texts))


def test_no_rule_sees_lines_without_cues(spark):
    line = "The trustees talked about the autumn market and listened to sailors at the town hall. "
    rows, scan = D.scanned(spark.createDataFrame([(line * 50,), (f"{line}\n{line}\nThis is Ann Lee\n{line}",), (None,)], "text string"))
    assert [r[0] for r in rows.select(scan.text).collect()] == ["", "This is Ann Lee", None]
