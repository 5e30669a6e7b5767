"""Parsing and rewriting of session logs held in one row."""

import json

from pyspark.sql import functions as F

from veil.operators.rewrite import log_texts, mask_log
from veil.operators.transcript import log_transcript
from veil.sources.logs import ambiguous_sql, entries, entry_rows, log_json, with_log

CALL = {"index": 1, "function": {"name": "faq", "arguments": '{"q": "Ann Lee"}'}, "id": "t1",
        "type": "function"}
CHAT = {"role": "user", "content": "I am Ann Lee", "turn": 1}
ARCH = {"architecture_type": "Neocortex"}
REFS = {"tool_calls": [{"turn": 1, "tool_calls": ["t1"]}]}
INTERACTION = {"chat_gpt": {
    "request": {"chat_history": [dict(CHAT, tool_calls=[CALL])], "functions": [
        {"name": "f", "parameters": {"type": "object", "properties": {
            "a": {"type": "string", "description": "d"}}, "required": ["a"]}}],
        "model": "m", "gpt_client": "c"},
    "response": {"agent": "x", "message": {"role": "assistant", "content": "Hi Ann Lee",
                                           "tool_calls": [CALL]}},
    "time": 1}}
TIMING = {"time_summary_s": {"total_function_times": {
    "timestamp": 1.5, "retrieve_state": 1, "get_rules": 0.0, "get_groups": 2, "get_devices": 3,
    "get_response": 4}, "total_request_time": 9.25}}


def frame(spark, logs):
    rows = [(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(logs)]
    return spark.createDataFrame(rows, "seq bigint, payload string")


def kinds(spark, log):
    rows = entry_rows(frame(spark, [log]), ["seq"]).orderBy("pos").collect()
    return [r["kind"] for r in rows]


def test_kind_of_each_shape(spark):
    assert kinds(spark, [ARCH, CHAT, REFS, INTERACTION, TIMING]) == [
        "architecture", "chat_message", "tool_call_refs", "chat_interaction", "time_summary"]


def test_types_are_not_coerced(spark):
    bad = [
        dict(CHAT, turn=1.5), dict(CHAT, turn="7"), dict(CHAT, content=None),
        dict(CHAT, turn=2**40), {"architecture_type": "Other"}, 5, "x", None,
        dict(CHAT, tool_calls=[dict(CALL, index="1")]), dict(CHAT, tool_calls=["t"]),
        {"tool_calls": [{"tool_calls": [1]}]},
        {"chat_gpt": dict(INTERACTION["chat_gpt"], time="1")},
        {"time_summary_s": {"total_request_time": 1}},
    ]
    assert kinds(spark, bad) == [None] * len(bad)


def test_optional_fields_may_be_null_or_absent(spark):
    ok = [dict(CHAT, turn=None, tool_calls=None), {"role": "r", "content": "c"},
          {"chat_gpt": dict(INTERACTION["chat_gpt"], response={})}]
    assert kinds(spark, ok) == ["chat_message", "chat_message", "chat_interaction"]


def test_message_with_empty_tool_calls_is_flagged(spark):
    df = entry_rows(frame(spark, [[dict(CHAT, tool_calls=[])]]), ["seq"])
    assert [(r["kind"], r["ambiguous_kind"]) for r in df.collect()] == [("chat_message", True)]
    assert "forall" in ambiguous_sql("e")


def test_only_one_json_array_is_a_log(spark):
    df = frame(spark, ["", "{}", "[]", "asdf", "[] x", "[],[]", "null", " [ ] "])
    got = df.select("seq", entries(F.col("payload")).alias("e")).orderBy("seq").collect()
    assert [r["e"] for r in got] == [None, None, [], None, None, None, None, []]


def test_one_bad_entry_spoils_the_log(spark):
    got = with_log(frame(spark, [[CHAT, {"x": 1}], [CHAT], []])).orderBy("seq").collect()
    assert [r["log"] is None for r in got] == [True, False, False]


def test_round_trip_drops_unknown_fields_and_absent_options(spark):
    log = [ARCH, dict(CHAT, extra=1), REFS, INTERACTION, TIMING, dict(CHAT, turn=None)]
    row = with_log(frame(spark, [log])).select(log_json(F.col("log")).alias("j")).first()
    back = json.loads(row["j"])
    assert back == [ARCH, CHAT, REFS, INTERACTION, TIMING, {"role": "user", "content": CHAT["content"]}]


def masked(spark, log, pairs, deep=False):
    df = with_log(frame(spark, [log])).withColumn("pairs", F.array(*[
        F.struct(F.lit(v).alias("value"), F.lit(r).alias("replacement")) for v, r in pairs
    ]) if pairs else F.array().cast("array<struct<value string, replacement string>>"))
    row = df.select(log_json(mask_log(F.col("log"), F.col("pairs"), deep)).alias("j")).first()
    return json.loads(row["j"])


def test_replacement_reaches_every_text_field(spark):
    log = [ARCH, dict(CHAT, tool_calls=[CALL]), REFS, INTERACTION, TIMING]
    out = masked(spark, log, [("Ann Lee", "[PERSON]")])
    assert out[0] == ARCH and out[2] == REFS and out[4] == TIMING
    assert out[1]["content"] == "I am [PERSON]"
    assert out[1]["tool_calls"][0]["function"]["arguments"] == '{"q": "[PERSON]"}'
    request, response = out[3]["chat_gpt"]["request"], out[3]["chat_gpt"]["response"]
    assert request["chat_history"][0]["content"] == "I am [PERSON]"
    # Tool calls of the history stay as they are.
    assert request["chat_history"][0]["tool_calls"] == [CALL]
    assert response["message"]["content"] == "Hi [PERSON]"
    assert response["message"]["tool_calls"][0]["function"]["arguments"] == '{"q": "[PERSON]"}'
    deep = masked(spark, log, [("Ann Lee", "[PERSON]")], deep=True)
    assert "Ann Lee" not in json.dumps(deep)


def test_interaction_without_answer_keeps_it_absent(spark):
    log = [{"chat_gpt": dict(INTERACTION["chat_gpt"], response={})}]
    assert masked(spark, log, [("Ann Lee", "[PERSON]")])[0]["chat_gpt"]["response"] == {}


SECRETS = ["José Muñoz", "Dock 9\tGate \"B\"", "ul. Łąkowa 4", "🔑 safe", "C:\\docs\\ann"]


def call_with(values, ascii_only):
    arguments = json.dumps({"who": values, "n": 1}, ensure_ascii=ascii_only)
    return dict(CALL, function={"name": "faq", "arguments": arguments})


def test_no_original_value_is_left_however_json_writes_it(spark):
    for ascii_only in (True, False):
        calls = [call_with([f"about {s}!" for s in SECRETS], ascii_only)]
        log = [{"role": "user", "content": " | ".join(SECRETS), "turn": 3, "tool_calls": calls}]
        out = masked(spark, log, [(s, f"[{k}]") for k, s in enumerate(SECRETS)])[0]
        tags = [f"[{k}]" for k in range(len(SECRETS))]
        assert out["content"] == " | ".join(tags)
        arguments = json.loads(out["tool_calls"][0]["function"]["arguments"])
        assert arguments == {"who": [f"about {t}!" for t in tags], "n": 1}


def test_arguments_that_are_no_json_are_plain_text(spark):
    call = dict(CALL, function={"name": "faq", "arguments": "who = Ann Lee"})
    out = masked(spark, [dict(CHAT, tool_calls=[call])], [("Ann Lee", "[X]")])[0]
    assert out["tool_calls"][0]["function"]["arguments"] == "who = [X]"


def test_empty_pairs_leave_the_log(spark):
    assert masked(spark, [CHAT], []) == [CHAT]


TRANSCRIPTS = [
    # What stands between the tags counts, whatever is around it.
    ([{"role": "assistant", "content": "<assistant_response>Gate 4 opens at noon</assistant_response> (draft 2)"},
      {"role": "user", "content": "<user_input>which gate</user_input> [asked twice]"}],
     "assistant: Gate 4 opens at noon\nuser: which gate\n"),
    # An open tag without its end is only taken out.
    ([{"role": "user", "content": "which <user_input>gate and when"},
      {"role": "assistant", "content": "<assistant_response>noon"}],
     "user: which gate and when\nassistant: noon\n"),
    # End tag first counts as a missing end tag; every other role is the assistant.
    ([{"role": "user", "content": "</user_input>a <user_input>b"},
      {"role": "system", "content": '"quoted" text"'}, {"role": "tool", "content": "x"},
      {"role": "User", "content": "y"}],
     'user: </user_input>a b\nassistant: quoted" text\nassistant: x\nassistant: y\n'),
    # Newlines become blanks, carriage returns stay, repeated lines go.
    ([{"role": "user", "content": "a\nb\r\nc"}, {"role": "user", "content": "a b\r c"},
      {"role": "assistant", "content": "<assistant_response>  z \t</assistant_response>"},
      {"role": "assistant", "content": "z"}],
     "user: a b\r c\nassistant: z\n"),
    ([ARCH, INTERACTION], ""),
]


def test_transcripts(spark):
    df = with_log(frame(spark, [log for log, _ in TRANSCRIPTS]))
    got = df.select("seq", log_transcript(F.col("log")).alias("t")).orderBy("seq").collect()
    assert [r["t"] for r in got] == [t for _, t in TRANSCRIPTS]


def test_texts_for_detection(spark):
    df = with_log(frame(spark, [[dict(CHAT, tool_calls=[CALL]), ARCH, INTERACTION]]))
    row = df.select(log_texts(F.col("log")).alias("a"),
                    log_texts(F.col("log"), "messages").alias("m")).first()
    assert row["m"] == "I am Ann Lee"
    assert row["a"].split("\n") == [
        "I am Ann Lee", '{"q": "Ann Lee"}', "I am Ann Lee", "Hi Ann Lee", '{"q": "Ann Lee"}']
