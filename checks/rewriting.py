"""Session logs: reading, classification, masking, and the complete job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from veil.functions.jsontext import encoded, is_json
from veil.operators import detect as D
from veil.operators import rewrite as W
from veil.operators.pairs import in_order
from veil.plans.large import mask_large
from veil.plans.mask import mask_sessions
from veil.schema import KIND_ARCHITECTURE, KIND_CHAT, KIND_INTERACTION, KIND_TIMING, KIND_TOOL_REFS
from veil.sources import envelopes as E
from veil.sources.logs import entries, entry_rows, log_json, with_log

KEYS = ["session_id", "part", "delivery"]


def _bigint(name: str):
    return F.col(name).cast("bigint").alias(name)


# --------------------------------------------------------------- reading

def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Publish the envelopes as files and read them back as a stream."""
    source, sink = I.shared_folder(spark, "ingest"), I.shared_folder(spark, "ingested")
    E.publish(I.envelopes(spark, sf), source)
    (
        E.stream_envelopes(spark, source, max_files_per_trigger=100).writeStream
        .option("checkpointLocation", f"{sink}/checkpoint").trigger(availableNow=True)
        .format("parquet").start(f"{sink}/rows").awaitTermination()
    )
    return spark.read.parquet(f"{sink}/rows").select(
        "seq", F.unix_seconds("published").alias("published_s"), "subject",
        E.session_name().alias("name"),
        F.char_length("payload").cast("bigint").alias("n_chars"),
    )


def parse_payload(spark: SparkSession, sf: str) -> DataFrame:
    return I.envelopes(spark, sf).select(
        *KEYS, F.size(entries(F.col("payload"))).cast("bigint").alias("n_entries"))


def entry_kind(spark: SparkSession, sf: str) -> DataFrame:
    return entry_rows(I.envelopes(spark, sf), KEYS).select(
        *KEYS, _bigint("pos"), "kind", "ambiguous_kind")


def log_validity(spark: SparkSession, sf: str) -> DataFrame:
    return with_log(I.envelopes(spark, sf)).select(*KEYS, F.col("log").isNotNull().alias("valid"))


def schema_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of every entry after a round trip through the fixed shapes."""
    back = with_log(I.envelopes(spark, sf)).select(*KEYS, log_json(F.col("log")).alias("json"))
    rows = back.select(*KEYS, F.posexplode(F.from_json("json", "array<string>")).alias("pos", "entry"))
    return rows.select(
        *KEYS, _bigint("pos"), F.array_join(F.sort_array(F.json_object_keys("entry")), ",").alias("fields"))


_PLACED = f"""{I.ENVELOPES},
placed AS (SELECT *, row_number() OVER (PARTITION BY session_id, part ORDER BY turn, slot) - 1 AS pos
  FROM log_entries),
sent AS (SELECT e.session_id, e.part, e.seq, published_s, subject, header, payload, delivery, body,
    payload = body AS whole, json_valid(payload) AND payload LIKE '[%' AS listed
  FROM envelopes e JOIN log_bodies b ON e.session_id = b.session_id AND e.part = b.part)"""
_KIND = ("CASE slot WHEN 0 THEN 'architecture' WHEN 1 THEN 'tool_call_refs' WHEN 2 THEN 'time_summary' "
         "WHEN 3 THEN 'chat_interaction' ELSE 'chat_message' END")
_BAD_ENTRY = ("SELECT session_id, part, delivery, json_array_length(payload) - 1 AS pos, NULL AS kind, "
              "false AS ambiguous_kind FROM sent WHERE listed AND NOT whole AND payload <> '[]'")
_FIELDS = ("CASE slot WHEN 0 THEN 'architecture_type' WHEN 1 THEN 'tool_calls' WHEN 2 THEN 'time_summary_s' "
           "WHEN 3 THEN 'chat_gpt' ELSE CASE WHEN turn % 3 = 2 THEN 'content,role,tool_calls,turn' "
           "ELSE 'content,role,turn' END END")


# ---------------------------------------------------------- masked logs

def masked_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the masked logs, read back from their JSON text."""
    done = mask_sessions(I.envelopes(spark, sf)).where("saved").select("session_name", "log")
    rows = with_log(done, "log", "entries").select("session_name", F.posexplode("entries").alias("pos", "e"))
    return rows.select("session_name", _bigint("pos"), "e")


def _of_kind(kind: str, **columns):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = masked_entries(spark, sf).where(F.col("e.kind") == kind)
        return rows.select("session_name", "pos", *[c.alias(n) for n, c in columns.items()])
    return query


_CHAT = f"e.{KIND_CHAT}"
_GPT = f"e.{KIND_INTERACTION}.chat_gpt"


def mask_tool_args(spark: SparkSession, sf: str) -> DataFrame:
    calls = F.col(f"{_CHAT}.tool_calls")
    rows = masked_entries(spark, sf).where(calls.isNotNull())
    return rows.select("session_name", "pos", W.arguments_valid(calls).alias("args_valid_json"),
                       F.explode(calls).alias("c")).select(
        "session_name", "pos", "args_valid_json", F.col("c.function.arguments").alias("arguments"),
        F.col("c.id").alias("id"))


def mask_large_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Every log cut into entries and masked in the long form: chat messages as on the way of small logs."""
    rows = mask_large(I.envelopes(spark, sf)).where(F.col("kind") == KIND_CHAT)
    message = F.from_json("entry", "role STRING, content STRING")
    return rows.select("session_name", "pos", message["role"].alias("role"), message["content"].alias("content"))


def mask_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences in JSON arguments of five spellings, masked and read back: each as the plain sentence."""
    texts = I.identifiers(spark, sf)
    pairs = D.detect(texts).where((F.col("value") != "") & (F.col("value") != F.col("replacement"))).groupBy("session_id").agg(
        in_order(F.collect_list(F.struct("value", "replacement"))).alias("pairs"))
    raw, one = F.col("raw"), lambda inner: F.concat(F.lit('{"q":"'), inner, F.lit('"}'))
    units = F.regexp_replace(F.hex(F.encode("text", "UTF-16BE")), "(....)", r"\\u$1")
    spelled = {
        "slashes": one(F.replace(raw, F.lit("/"), F.lit("\\/"))),
        "units": one(units),
        "beside": one(F.concat(F.lit("C:\\\\users "), F.replace(raw, F.lit("a"), F.lit("\\u0061")))),
        "quoted": one(F.concat(F.lit("say \\u0022"), raw, F.lit("\\u0022"))),
        "nested": F.to_json(F.struct(one(raw).alias("q"))),
    }
    kinds = F.array(*(F.struct(F.lit(k).alias("spelling"), a.alias("arguments")) for k, a in spelled.items()))
    # Spelled in steps of their own: a generator would write each text out again for every use of it.
    given = texts.withColumn("raw", encoded(F.col("text"))).select("session_id", "turn", kinds.alias("spelled"))
    done = given.join(pairs, "session_id", "left").select("session_id", "turn", "pairs", F.explode("spelled").alias("s")).select(
        "session_id", "turn", "s.spelling",
        W.mask_arguments(F.col("s.arguments"), F.coalesce("pairs", F.array().cast("array<struct<value string, replacement string>>"))).alias("masked"))
    said = F.get_json_object("masked", "$.q")
    return done.select(
        "session_id", "turn", "spelling", is_json(F.col("masked")).alias("valid"),
        F.when(F.col("spelling") == "nested", F.get_json_object(said, "$.q"))
        .when(F.col("spelling") == "beside", F.regexp_replace(said, r"^C:\\users ", ""))
        .when(F.col("spelling") == "quoted", F.regexp_replace(said, '^say "|"$', "")).otherwise(said).alias("said"))


def passthrough(spark: SparkSession, sf: str) -> DataFrame:
    rows = masked_entries(spark, sf).where(
        F.col("e.kind").isin(KIND_ARCHITECTURE, KIND_TOOL_REFS, KIND_TIMING))
    return rows.select(
        "session_name", "pos", F.col("e.kind").alias("kind"),
        F.col(f"e.{KIND_ARCHITECTURE}.architecture_type").alias("architecture"),
        F.get(F.get(F.col(f"e.{KIND_TOOL_REFS}.tool_calls"), F.lit(0))["tool_calls"], F.lit(0)).alias("ref"),
        F.col(f"e.{KIND_TIMING}.time_summary_s.total_request_time").alias("total"))


def rebuild_log(spark: SparkSession, sf: str) -> DataFrame:
    done = mask_sessions(I.envelopes(spark, sf)).where("saved").select("session_name", "log")
    kinds = F.transform("entries", lambda e: e["kind"])
    return with_log(done, "log", "entries").select("session_name", F.array_join(kinds, ",").alias("kinds"))


def _masked_turns(spark: SparkSession, texts: DataFrame) -> DataFrame:
    return W.mask_turns(texts, D.detect(texts))


def apply_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _masked_turns(spark, I.corpus(spark, sf)).select("session_id", "turn", "masked_text", "n_pairs")


def mask_noop(spark: SparkSession, sf: str) -> DataFrame:
    return _masked_turns(spark, I.corpus(spark, sf)).where("n_pairs = 0").select(
        "session_id", "turn", "masked_text")


def said(log: str = "log"):
    """Contents of the chat messages of a log, one per line."""
    def query(rows: DataFrame) -> DataFrame:
        contents = F.transform(
            F.filter("_entries", lambda e: e["kind"] == KIND_CHAT), lambda e: e[KIND_CHAT]["content"])
        return with_log(rows, log, "_entries").withColumn("said", F.array_join(contents, "\n")).drop("_entries")
    return query


def mask_all(spark: SparkSession, sf: str) -> DataFrame:
    done = mask_sessions(I.envelopes(spark, sf))
    return said()(done).select(
        "seq", "session_name", "disposition", "saved", "retry", "pair_status",
        F.size("pairs").cast("bigint").alias("n_pairs"), "said")


QUERIES = {
    "stream_ingest": stream_ingest,
    "route_subject": lambda spark, sf: E.of_subject(
        I.envelopes(spark, sf), I.TENANT, I.APPLICATION, I.SUBJECT).select(*KEYS),
    "session_name": lambda spark, sf: I.envelopes(spark, sf).select(*KEYS, E.session_name().alias("name")),
    "envelope_defaults": lambda spark, sf: E.with_defaults(I.envelopes(spark, sf)).select(
        *KEYS, "seq", F.unix_seconds("published").alias("published_s")),
    "parse_payload": parse_payload,
    "entry_kind": entry_kind,
    "log_validity": log_validity,
    "schema_projection": schema_projection,
    "apply_pairs": apply_pairs,
    "mask_chat": lambda spark, sf: _of_kind(
        KIND_CHAT, role=F.col(f"{_CHAT}.role"), content=F.col(f"{_CHAT}.content"))(spark, sf),
    "mask_tool_args": mask_tool_args,
    "mask_spellings": mask_spellings,
    "mask_large_logs": mask_large_logs,
    "mask_history": lambda spark, sf: _of_kind(
        KIND_INTERACTION,
        content=F.get(F.col(f"{_GPT}.request.chat_history"), F.lit(0))["content"],
        arguments=F.get(F.get(F.col(f"{_GPT}.request.chat_history"), F.lit(0))["tool_calls"], F.lit(0))[
            "function"]["arguments"])(spark, sf),
    "mask_response": lambda spark, sf: _of_kind(
        KIND_INTERACTION,
        content=F.col(f"{_GPT}.response.message.content"),
        arguments=F.get(F.col(f"{_GPT}.response.message.tool_calls"), F.lit(0))["function"]["arguments"],
        agent=F.col(f"{_GPT}.response.agent"))(spark, sf),
    "passthrough": passthrough,
    "rebuild_log": rebuild_log,
    "mask_noop": mask_noop,
    "mask_sessions": mask_all,
}

_MASKED = f"""{_PLACED},
{S.found('log_parts', 'session_id, part')},
pairs AS ({S.ordered_pairs('found', 'session_id, part')}),
saved AS (SELECT session_id, part, delivery, header AS session_name FROM sent
  WHERE header <> '' AND whole)"""


def _masked_rows(columns: str, where: str) -> str:
    return (
        f"WITH {_MASKED}\nSELECT session_name, pos, {columns} FROM saved JOIN placed USING (session_id, part) "
        f"JOIN log_parts USING (session_id, part, turn) LEFT JOIN pairs USING (session_id, part) WHERE {where}"
    )


_ARGS = "CAST(json_object('q', text) AS VARCHAR)"
_TURNS_MASKED = (
    f"WITH {I.CORPUS},\n{S.found()},\npairs AS ({S.ordered_pairs()})\n"
    f"SELECT session_id, turn, {S.applied('text')} AS masked_text, "
    "coalesce(len(list_filter(p, lambda x: contains(text, x.v))), 0) AS n_pairs "
    "FROM corpus LEFT JOIN pairs USING (session_id)"
)
_SPELLINGS_MASKED = (
    f"WITH {I.IDENTIFIERS},\n{S.found('identifiers')},\npairs AS ({S.ordered_pairs()})\n"
    f"SELECT session_id, turn, unnest(['slashes', 'units', 'beside', 'quoted', 'nested']) AS spelling, true AS valid, {S.applied('text')} AS said "
    "FROM identifiers LEFT JOIN pairs USING (session_id)"
)
# Messages with what became of them; ``said`` only for saved logs.
MESSAGES = (
    f"{_MASKED},\nsaids AS (SELECT session_id, part, string_agg({S.applied('text')}, chr(10) ORDER BY turn) AS said "
    "FROM log_parts LEFT JOIN pairs USING (session_id, part) GROUP BY session_id, part),\n"
    "outcomes AS (SELECT session_id, part, delivery, coalesce(seq, 0) AS seq, nullif(header, '') AS session_name, payload, whole, "
    "CASE WHEN coalesce(header, '') = '' THEN 'no_session_name' WHEN NOT (whole OR payload = '[]') THEN 'parse_error' "
    "ELSE 'ok' END AS disposition FROM sent),\n"
    "messages AS (SELECT o.seq, o.session_name, o.disposition, o.disposition = 'ok' AS saved, "
    "o.disposition = 'no_session_name' AS retry, "
    "CASE WHEN whole AND p IS NOT NULL THEN 'found' ELSE 'none_found' END AS pair_status, "
    "CASE WHEN whole THEN coalesce(len(p), 0) ELSE 0 END AS n_pairs, "
    "CASE WHEN o.disposition = 'ok' THEN CASE WHEN whole THEN said ELSE '' END END AS said, "
    "o.delivery FROM outcomes o JOIN saids USING (session_id, part) LEFT JOIN pairs USING (session_id, part))"
)

_PART = "session_id, part, delivery"
ORACLES = {
    "stream_ingest": (
        f"WITH {I.ENVELOPES}\nSELECT seq, published_s, subject, nullif(header, '') AS name, "
        "len(payload) AS n_chars FROM envelopes"),
    "route_subject": f"WITH {I.ENVELOPES}\nSELECT {_PART} FROM envelopes WHERE subject = 'acme.chat.mask'",
    "session_name": f"WITH {I.ENVELOPES}\nSELECT {_PART}, nullif(header, '') AS name FROM envelopes",
    "envelope_defaults": (
        f"WITH {I.ENVELOPES}\nSELECT {_PART}, coalesce(seq, 0) AS seq, coalesce(published_s, 0) AS published_s FROM envelopes"),
    "parse_payload": (
        f"WITH {_PLACED}\nSELECT {_PART}, CASE WHEN listed THEN CAST(json_array_length(payload) AS BIGINT) END AS n_entries FROM sent"),
    "entry_kind": (
        f"WITH {_PLACED}\nSELECT {_PART}, pos, {_KIND} AS kind, false AS ambiguous_kind FROM sent "
        f"JOIN placed USING (session_id, part) WHERE listed AND payload <> '[]' UNION ALL {_BAD_ENTRY}"),
    "log_validity": f"WITH {_PLACED}\nSELECT {_PART}, whole OR payload = '[]' AS valid FROM sent",
    "schema_projection": (
        f"WITH {_PLACED}\nSELECT {_PART}, pos, {_FIELDS} AS fields FROM sent JOIN placed USING (session_id, part) WHERE whole"),
    "apply_pairs": _TURNS_MASKED,
    "mask_chat": _masked_rows(f"role, {S.applied('text')} AS content", "slot = 4"),
    "mask_tool_args": _masked_rows(
        f"{S.applied(_ARGS)} AS arguments, json_valid({S.applied(_ARGS)}) AS args_valid_json, "
        "concat('call_', turn) AS id", "slot = 4 AND turn % 3 = 2"),
    "mask_spellings": _SPELLINGS_MASKED,
    "mask_large_logs": _masked_rows(f"role, {S.applied('text')} AS content", "slot = 4"),
    "mask_history": _masked_rows(f"{S.applied('text')} AS content, {_ARGS} AS arguments", "slot = 3"),
    "mask_response": _masked_rows(
        f"{S.applied('text')} AS content, {S.applied(_ARGS)} AS arguments, 'agent' AS agent", "slot = 3"),
    "passthrough": _masked_rows(
        f"{_KIND} AS kind, CASE slot WHEN 0 THEN 'Neocortex' END AS architecture, "
        "CASE slot WHEN 1 THEN 'call_2' END AS ref, CASE slot WHEN 2 THEN 3.5::DOUBLE END AS total", "slot < 3"),
    "rebuild_log": (
        f"WITH {_PLACED},\nkinds AS (SELECT session_id, part, string_agg({_KIND}, ',' ORDER BY pos) AS kinds "
        "FROM placed GROUP BY session_id, part)\nSELECT header AS session_name, CASE WHEN whole THEN kinds ELSE '' END AS kinds "
        "FROM sent JOIN kinds USING (session_id, part) WHERE header <> '' AND (whole OR payload = '[]')"),
    "mask_noop": f"SELECT session_id, turn, masked_text FROM ({_TURNS_MASKED}) WHERE n_pairs = 0",
    "mask_sessions": (
        f"WITH {MESSAGES}\nSELECT seq, session_name, disposition, saved, retry, pair_status, n_pairs, said FROM messages"),
}
