"""Word lists and allow lists in the complete job."""

import json

from veil.plans.mask import mask_sessions
from veil.streaming.jobs import lists_process


def messages(spark, contents):
    rows = [(k, {"session_name": "x"}, json.dumps([{"role": "user", "content": c}])) for k, c in enumerate(contents)]
    df = spark.createDataFrame(rows, "seq bigint, headers map<string,string>, payload string")
    from veil.schema import SESSION_HEADER

    return df.selectExpr("seq", "timestamp_seconds(0) AS published", "'s' AS subject", f"map('{SESSION_HEADER}', concat('log', seq)) AS headers", "payload")


def said(rows):
    return {r.seq: json.loads(r.log)[0]["content"] for r in rows.collect()}


def test_terms_are_masked_and_allowed_values_stay(spark):
    texts = ["wrote to ann@example.org and Grand Hotel Budapest", "nothing here", "she has chronic asthma, ask info@example.org", "nothing here"]
    terms = spark.createDataFrame([("Grand Hotel Budapest", "LOCATION"), ("chronic asthma", "DEFAULT"), ("Elsewhere", "NO_SUCH")], "term string, operator string")
    allow = spark.createDataFrame([("INFO@example.org",), ("unused",)], "value string")
    df = messages(spark, texts)
    plain = said(mask_sessions(df))
    assert "Grand Hotel Budapest" in plain[0] and "info@example.org" not in plain[2]
    got = said(mask_sessions(df, terms=terms, allow=allow))
    assert "Grand Hotel" not in got[0] and "ann@example.org" not in got[0]
    assert "asthma" not in got[2] and "info@example.org" in got[2]
    assert got[1] == got[3] == "nothing here" and len(got) == 4
    assert said(lists_process(terms, allow)(df, 0)) == got


def test_one_list_without_the_other(spark):
    df = messages(spark, ["Grand Hotel Budapest, ann@example.org"])
    terms = spark.createDataFrame([("Grand Hotel Budapest", "LOCATION")], "term string, operator string")
    assert said(mask_sessions(df, terms=terms))[0].count("Hotel") == 0
    allow = spark.createDataFrame([("ann@example.org",)], "value string")
    assert said(mask_sessions(df, allow=allow))[0] == "Grand Hotel Budapest, ann@example.org"
