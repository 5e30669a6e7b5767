"""Shape of the physical plans, and cases of detection."""

import re

import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from veil.functions import masking
from veil.operators import detect as D
from veil.operators.optable import default_table
from veil.plans.mask import mask_sessions, mask_with_model
from veil.schema import ENVELOPE, OPERATORS
from veil.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def envelopes(spark, payloads):
    rows = [(i, None, "s", {"session_log_name": f"n{i}"}, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, ENVELOPE)


def test_masking_of_logs_needs_no_shuffle_and_no_python(spark):
    text = plan(mask_sessions(envelopes(spark, ["[]"])).where("saved"))
    assert "Exchange" not in text
    assert not re.search("Python|Pandas|Arrow", text)


def test_detection_is_one_pass_and_one_shuffle(spark):
    docs = read_table(spark, SF, "documents").selectExpr("doc_id AS session_id", "text")
    text = plan(D.detect(docs))
    assert text.count("Generate explode") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan") == 1
    assert "lang" not in re.findall(r"ReadSchema: \S+", text)[0]


@pytest.mark.parametrize("payload", ["", "{}", "[]", "asdf"])
def test_empty_payloads(spark, payload):
    row = mask_sessions(envelopes(spark, [payload])).first()
    assert row["disposition"] == ("ok" if payload == "[]" else "parse_error")
    assert row["log"] == ("[]" if payload == "[]" else None)


CASES = {
    "my card is 4111 1111 1111 1111.": {"4111 1111 1111 1111": "4111 **** **** ****"},
    "mail user@mail.com now": {"user@mail.com": "use**********"},
    "mail clerk@office.example now": {"clerk@office.example": "clerk@offi**********"},
    "a@b.co": {"a@b.co": "******"},
    "call +1 (415) 555-1234, 415-555-9876": {
        "+1 (415) 555-1234": "+1 (415) 5**-****", "415-555-9876": "415-5**-****"},
    "My name is Ana. This is Camera": {"Ana": "[PERSON]"},
    "pin 1234 but pin 12345 is none, cvv: 123": {"1234": "[PIN]", "123": "[CREDIT_CARD_CVV]"},
    "paid by card 5500 0000 0000 0004 and left": {"5500 0000 0000 0004": "5500 **** **** ****"},
    "card 4111-1111-1111-1111 4111_1111_1111_1111": {
        "4111-1111-1111-1111": "4111-****-****-****", "4111_1111_1111_1111": "4111_****_****_****"},
    "number 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1": {
        "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1": "4 1 1 1 * * * * * * * * * * * *"},
    "at 10:30 it is 21 degrees in English": {},
    "the kitchen light, 2024-01-05T10:30:00": {},
    "ITIN 912-73-1234 and SSN 123-45-6789": {"912-73-1234": "[US_ITIN]", "123-45-6789": "[US_SSN]"},
    "10.0.0.1\n1.2.3.4.5\n300.1.1.1": {"10.0.0.1": "[REDACTED]"},
    "see https://a.example/x?y=1, and www.b.example.": {
        "https://a.example/x?y=1": "[URL]", "www.b.example": "[URL]"},
    "": {},
}


def test_detection_cases(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "session_id int, text string")
    rows = D.with_found(df).orderBy("session_id").collect()
    got = [{p["value"]: p["replacement"] for p in r["found"]} for r in rows]
    assert got == list(CASES.values())
    long = {i: {} for i in range(len(CASES))}
    for r in D.detect(df).collect():
        long[r["session_id"]][r["value"]] = r["replacement"]
    assert list(long.values()) == list(CASES.values())


def test_null_text_has_no_values(spark):
    df = spark.createDataFrame([(1, None)], "session_id int, text string")
    assert D.with_found(df).first()["found"] == []
    assert D.detect(df).count() == 0


def test_table_driven_masks_agree_with_literal_ones(spark):
    values = spark.createDataFrame([("+1 (415) 555-1234",), ("ab",), ("a_b-c d",)], "v string")
    table = default_table(spark)
    rows = values.crossJoin(F.broadcast(table)).select(
        masking.mask_by_operator(
            F.col("v"), F.col("type"), F.col("new_value"), F.col("masking_char"),
            F.col("chars_to_mask"), F.col("from_end"),
            F.col("name").isin(*masking.KEEP_SEPARATORS)).alias("a"),
        masking.replacement(F.col("name"), F.col("v")).alias("b")).collect()
    assert len(rows) == 3 * len(OPERATORS)
    assert all(r["a"] == r["b"] for r in rows)
    from_start = values.select(masking.mask_chars(F.col("v"), 3, "#", False).alias("m")).collect()
    assert {r["m"] for r in from_start} == {"###(415) 555-1234", "##", "###-c d"}


def test_model_sees_each_transcript_once(spark):
    log = '[{"role":"user","content":"I am Ann Lee"}]'

    def factory():
        import json

        def answer(texts, prompt, model):
            assert len(set(texts)) == len(texts)
            content = json.dumps({"redactions": {"Ann Lee": "[PERSON]"}})
            return [json.dumps({"choices": [{"message": {"content": content}}]}) for _ in texts]
        return answer

    rows = mask_with_model(envelopes(spark, [log, log, "{}"]), factory, "p", "m").orderBy("seq").collect()
    assert [r["disposition"] for r in rows] == ["ok", "ok", "parse_error"]
    assert rows[0]["log"] == '[{"role":"user","content":"I am [PERSON]"}]'


def test_derived_inputs_cover_every_operator(spark):
    found = D.detect(I.corpus(spark, SF)).select("operator").distinct().collect()
    assert {r["operator"] for r in found} == {op.name for op in OPERATORS}
