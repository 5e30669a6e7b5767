"""Model responses: scanning, repair, validation; the model detector and its memo."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from checks.sqltext import q
from veil.operators import model as M
from veil.operators import pairs as P
from veil.operators.transcript import transcripts
from veil.schema import OPERATORS
from veil.sources.responses import read_responses

TAGS = tuple(op.new_value for op in OPERATORS if op.new_value)


def _tags():
    return F.array(*[F.lit(t) for t in TAGS])


def response_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = I.shared_folder(spark, "responses")
    I.responses(spark, sf).write.json(path)
    parsed = P.strict_json(F.col("response"))
    return read_responses(spark, path, "session_id BIGINT").select(
        "session_id",
        F.try_variant_get(parsed, "$.id", "string").alias("id"),
        F.size(F.try_variant_get(parsed, "$.choices", "array<variant>")).cast("bigint").alias("n_choices"),
    )


def extract_content(spark: SparkSession, sf: str) -> DataFrame:
    return I.responses(spark, sf).select("session_id", P.first_content(F.col("response")).alias("content"))


def explode_choices(spark: SparkSession, sf: str) -> DataFrame:
    return P.choices(I.responses(spark, sf), ["session_id"]).withColumn("choice", F.col("choice").cast("bigint"))


def _redactions(spark: SparkSession, sf: str) -> DataFrame:
    return extract_content(spark, sf).select("session_id", P.redactions(F.col("content")).alias("m"))


def parse_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _redactions(spark, sf).select("session_id", F.explode("m").alias("e")).select(
        "session_id", F.col("e.key").alias("raw_key"))


def _listed(rows: DataFrame, array, *fields: str) -> DataFrame:
    return rows.select("session_id", F.explode(array).alias("p")).select(
        "session_id", *[F.col(f"p.{f}").alias(f) for f in fields])


def string_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(_redactions(spark, sf), P.string_pairs(F.col("m")), "raw_key", "raw_value")


def _oriented(spark: SparkSession, sf: str, keep) -> DataFrame:
    rows = _redactions(spark, sf)
    return _listed(rows, P.valid(P.orient(P.string_pairs(F.col("m"))), keep), "raw_key", "value", "replacement")


def collide_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = _redactions(spark, sf).withColumn(
        "indexed", P.in_key_order(P.orient(P.string_pairs(F.col("m")))))
    return _listed(rows, P.settle("indexed"), "value", "replacement")


def pair_status(spark: SparkSession, sf: str) -> DataFrame:
    return P.with_pairs(I.responses(spark, sf), "response", _tags()).select(
        "session_id", "pair_status", F.size("pairs").cast("bigint").alias("n_pairs"))


CONTENTS = f"""{I.RESPONSES},
contents AS (SELECT session_id, response, CASE WHEN json_type(response, '$.choices[0].message.content') = 'VARCHAR'
    THEN json_extract_string(response, '$.choices[0].message.content') END AS content FROM responses),
maps AS (SELECT session_id, content, CASE WHEN json_valid(content) THEN
    CASE WHEN json_type(content, '$.redactions') = 'OBJECT' THEN json_extract(content, '$.redactions') END END AS m
  FROM contents),
items AS (SELECT session_id, unnest(json_keys(m)) AS raw_key, unnest(json_extract(m, '$.*')) AS item FROM maps),
texts AS (SELECT session_id, raw_key, item ->> '$' AS raw_value FROM items WHERE json_type(item) = 'VARCHAR'),
oriented AS (SELECT session_id, raw_key, CASE WHEN turned THEN raw_value ELSE raw_key END AS value,
    CASE WHEN turned THEN raw_key ELSE raw_value END AS replacement
  FROM (SELECT *, (raw_key LIKE '[%' AND raw_key LIKE '%]') OR (strlen(raw_key) > 4 AND raw_key LIKE '%****'
    AND NOT contains(substr(raw_key, 1, 4), '*')) AS turned FROM texts)),
valid AS (SELECT * FROM oriented WHERE NOT (replacement LIKE '[%' AND replacement LIKE '%]')
  OR replacement IN ({', '.join(q(t) for t in TAGS)})),
settled AS (SELECT session_id, value, replacement FROM oriented QUALIFY row_number() OVER (
  PARTITION BY session_id, value ORDER BY raw_key DESC) = 1)"""


# ------------------------------------------------------------ model and memo

def stand_in():
    """Deterministic model: fails always, or once, for texts of certain lengths."""
    tried: set[str] = set()

    def answer(texts: Sequence[str], prompt: str, model: str) -> list[str | None]:
        out: list[str | None] = []
        for t in texts:
            broken = len(t) % 7 == 0 or (len(t) % 5 == 0 and t not in tried)
            tried.add(t)
            out.append("not-json" if broken else json.dumps({"n": len(t), "model": model}))
        return out

    return answer


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    texts = transcripts(I.tagged(spark, sf)).select(F.col("transcript").alias("text"))
    return M.answers(texts, stand_in, "prompt", "m1")


def detect_model(spark: SparkSession, sf: str) -> DataFrame:
    return _calls(spark, sf).select("text_key", F.get_json_object("response", "$.n").cast("bigint").alias("n"))


def detect_retry(spark: SparkSession, sf: str) -> DataFrame:
    return _calls(spark, sf).select(
        "text_key", F.col("response").isNotNull().alias("answered"), F.col("attempts").cast("bigint").alias("attempts"))


def request_body(spark: SparkSession, sf: str) -> DataFrame:
    body = M.request_body(F.lit("m1"), F.lit("Be brief."), F.col("text"))
    rows = I.turns(spark, sf).select("session_id", "turn", F.try_parse_json(body).alias("b"))
    fields = {
        "model": "$.model", "role_0": "$.messages[0].role", "system": "$.messages[0].content",
        "role_1": "$.messages[1].role", "said": "$.messages[1].content",
    }
    return rows.select(
        "session_id", "turn",
        *[F.try_variant_get("b", path, "string").alias(n) for n, path in fields.items()],
        F.try_variant_get("b", "$.temperature", "bigint").alias("temperature"))


_STATUS = "CASE session_id % 5 WHEN 0 THEN 500 WHEN 1 THEN 200 WHEN 2 THEN 204 WHEN 3 THEN 299 ELSE 300 END"
_BODY = "CASE session_id % 4 WHEN 0 THEN response WHEN 1 THEN 'not-json' WHEN 2 THEN '' ELSE concat(response, ' x') END"


def response_ok(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.responses(spark, sf).selectExpr("session_id", f"{_STATUS} AS status", f"{_BODY} AS body")
    body = M.accepted(F.col("status"), F.col("body"))
    return rows.select("session_id", body.isNotNull().alias("answered"))




def memo(spark: SparkSession, sf: str) -> DataFrame:
    """Answers to the texts of even length, given at a time that depends on the text."""
    texts = I.tagged(spark, sf).select("text").distinct().where(F.char_length("text") % 2 == 0)
    return M.keyed(texts).select(
        "text_key", "text", F.concat(F.lit('{"n":'), F.char_length("text").cast("string"), F.lit("}")).alias("response"),
        F.timestamp_seconds(F.lit(1704067200) + F.char_length("text")).alias("responded_at"))


MEMO = f"""{I.TAGGED},
memo AS (SELECT sha256(text) AS text_key, text, concat('{{"n":', len(text), '}}') AS response,
  1704067200 + len(text) AS responded_s FROM (SELECT DISTINCT text FROM tagged) WHERE len(text) % 2 = 0)"""


def memo_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.tagged(spark, sf).select("session_id", "turn", "text")
    found = M.answers(rows, stand_in, "prompt", "m1", memo(spark, sf))
    return M.with_answers(rows, found).select(
        "session_id", "turn", F.get_json_object("response", "$.n").cast("bigint").alias("n"),
        F.col("attempts").cast("bigint").alias("attempts"))


def memo_misses(spark: SparkSession, sf: str) -> DataFrame:
    return M.memo_misses(I.tagged(spark, sf), memo(spark, sf)).select("text_key")


# Half of the texts are shorter than this many characters, so half of the memo is too old.
_NOW = 1704067200 + 3600 + 300


def memo_ttl(spark: SparkSession, sf: str) -> DataFrame:
    now = F.timestamp_seconds(F.lit(_NOW))
    return M.live_memo(memo(spark, sf), now).select("text_key", F.unix_seconds("responded_at").alias("responded_s"))


def header_durations(spark: SparkSession, sf: str) -> DataFrame:
    took = F.lit(M.DURATION_HEADER)
    headers = F.when(F.col("event_id") % 3 == 0, F.create_map(took, F.col("user_id").cast("string"))).when(
        F.col("event_id") % 3 == 1, F.create_map(F.lit(M.OVERHEAD_HEADER), F.lit("2"), took, F.lit("9")))
    rows = I.table(spark, sf, "events").select("event_id", headers.alias("h"))
    return rows.select("event_id", M.reported(F.col("h"), M.DURATION_HEADER).alias("duration"),
                       M.reported(F.col("h"), M.OVERHEAD_HEADER).alias("overhead"))


QUERIES = {
    "response_scan": response_scan,
    "extract_content": extract_content,
    "explode_choices": explode_choices,
    "parse_pairs": parse_pairs,
    "string_pairs": string_pairs,
    "orient_pairs": lambda spark, sf: _oriented(spark, sf, None),
    "valid_pairs": lambda spark, sf: _oriented(spark, sf, _tags()),
    "valid_pairs_none": lambda spark, sf: _oriented(spark, sf, F.lit(None).cast("array<string>")),
    "collide_pairs": collide_pairs,
    "pair_status": pair_status,
    "detect_model": detect_model,
    "detect_retry": detect_retry,
    "request_body": request_body,
    "response_ok": response_ok,
    "memo_join": memo_join,
    "memo_misses": memo_misses,
    "memo_ttl": memo_ttl,
    "header_durations": header_durations,
}

_CALLED = "len(transcript) % 7 <> 0"


def _model_sql(columns: str) -> str:
    from checks.transcripts import LINES

    return (
        f"WITH {LINES},\nparts AS (SELECT string_agg(line, '' ORDER BY turn, line) AS transcript "
        "FROM firsts GROUP BY session_id),\ncalls AS (SELECT DISTINCT transcript FROM parts)\n"
        f"SELECT sha256(transcript) AS text_key, {columns} FROM calls"
    )


ORACLES = {
    "response_scan": f"WITH {I.RESPONSES}\nSELECT session_id, json_extract_string(response, '$.id') AS id, "
                     "CAST(json_array_length(response, '$.choices') AS BIGINT) AS n_choices FROM responses",
    "extract_content": f"WITH {CONTENTS}\nSELECT session_id, content FROM contents",
    "explode_choices": (
        f"WITH {CONTENTS},\nanswers AS (SELECT session_id, generate_subscripts(a, 1) - 1 AS choice, unnest(a) AS answer "
        "FROM (SELECT session_id, json_extract(response, '$.choices[*]') AS a FROM responses))\n"
        "SELECT session_id, choice, CASE WHEN json_type(answer, '$.message.content') = 'VARCHAR' THEN "
        "json_extract_string(answer, '$.message.content') END AS content FROM answers"),
    "parse_pairs": f"WITH {CONTENTS}\nSELECT session_id, raw_key FROM items",
    "string_pairs": f"WITH {CONTENTS}\nSELECT * FROM texts",
    "orient_pairs": f"WITH {CONTENTS}\nSELECT * FROM oriented",
    "valid_pairs": f"WITH {CONTENTS}\nSELECT * FROM valid",
    "valid_pairs_none": f"WITH {CONTENTS}\nSELECT * FROM oriented",
    "collide_pairs": f"WITH {CONTENTS}\nSELECT * FROM settled",
    "pair_status": (
        f"WITH {CONTENTS},\nkept AS (SELECT session_id, count(*) AS n FROM (SELECT * FROM valid QUALIFY row_number() OVER "
        "(PARTITION BY session_id, value ORDER BY raw_key DESC) = 1) WHERE value <> '' AND value <> replacement GROUP BY session_id)\n"
        "SELECT session_id, CASE WHEN content IS NULL THEN 'no_content' WHEN m IS NULL THEN 'unparsed' "
        "WHEN coalesce(n, 0) = 0 THEN 'none_found' ELSE 'found' END AS pair_status, coalesce(n, 0) AS n_pairs "
        "FROM maps LEFT JOIN kept USING (session_id)"),
    "detect_model": _model_sql(f"CASE WHEN {_CALLED} THEN len(transcript) END AS n"),
    "detect_retry": _model_sql(
        f"{_CALLED} AS answered, CASE WHEN len(transcript) % 7 = 0 THEN 3 WHEN len(transcript) % 5 = 0 THEN 2 ELSE 1 END AS attempts"),
    "request_body": f"WITH {I.TURNS}\nSELECT session_id, turn, 'm1' AS model, 'system' AS role_0, 'Be brief.' AS system, "
                    "'user' AS role_1, text AS said, 0 AS temperature FROM turns",
    "response_ok": f"WITH {I.RESPONSES}\nSELECT session_id, session_id % 5 IN (1, 2, 3) AND session_id % 4 = 0 AS answered FROM responses",
    "memo_join": (
        f"WITH {MEMO}\nSELECT session_id, turn, CASE WHEN len(t.text) % 2 = 0 OR len(t.text) % 7 <> 0 THEN len(t.text) END AS n, "
        "CASE WHEN m.text IS NOT NULL THEN 0 WHEN len(t.text) % 7 = 0 THEN 3 WHEN len(t.text) % 5 = 0 THEN 2 ELSE 1 END AS attempts "
        "FROM tagged t LEFT JOIN memo m ON t.text = m.text"),
    "memo_misses": f"WITH {MEMO}\nSELECT DISTINCT sha256(text) AS text_key FROM tagged WHERE text NOT IN (SELECT text FROM memo)",
    "memo_ttl": (
        f"WITH {MEMO}\nSELECT text_key, responded_s FROM memo WHERE responded_s > {_NOW} - 3600 "
        "ORDER BY responded_s DESC, text_key"),
    "header_durations": (
        "SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '9' ELSE '0' END AS duration, "
        "CASE event_id % 3 WHEN 1 THEN '2' ELSE '0' END AS overhead FROM events"),
}
