"""Transcripts, operator tables of prompts, and text compression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from checks.sqltext import q
from veil.functions.text import between_tags, flatten_newlines
from veil.operators import brevity, optable
from veil.operators import transcript as T
from veil.schema import KIND_CHAT
from veil.sources.logs import with_log



def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    return I.tagged(spark, sf).withColumn("flat", flatten_newlines(F.col("text")))


def _said(role_is_user: bool, tag: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = _tagged(spark, sf)
        flat = F.col("flat")
        rows = rows.where((F.col("role") == "user") == F.lit(role_is_user))
        other = flat if role_is_user else F.btrim(flat, F.lit('"'))
        return rows.select("session_id", "turn", between_tags(flat, tag, other).alias("said"))
    return query


def user_tag_open(spark: SparkSession, sf: str) -> DataFrame:
    rows = _tagged(spark, sf)
    flat = F.col("flat")
    open_only = F.contains(flat, F.lit("<user_input>")) & ~F.contains(flat, F.lit("</user_input>"))
    return rows.where((F.col("role") == "user") & open_only).select(
        "session_id", "turn", between_tags(flat, "user_input", flat).alias("said")
    )


def assistant_quotes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _tagged(spark, sf)
    flat = F.col("flat")
    plain = ~F.contains(flat, F.lit("<assistant_response>"))
    return rows.where((F.col("role") != "user") & plain).select(
        "session_id", "turn", T.spoken(F.col("role"), flat).alias("said")
    )


def dedup_lines(spark: SparkSession, sf: str) -> DataFrame:
    return T.distinct_lines(T.turn_lines(I.tagged(spark, sf))).select("session_id", "turn", "line")


def chat_only(spark: SparkSession, sf: str) -> DataFrame:
    logs = with_log(I.envelopes(spark, sf))
    rows = logs.select("session_id", "part", "delivery", F.posexplode("log").alias("pos", "e"))
    return rows.where(F.col("e.kind") == KIND_CHAT).select(
        "session_id", "part", "delivery", F.col("pos").cast("bigint").alias("pos"),
        F.col(f"e.{KIND_CHAT}.role").alias("role"), F.col(f"e.{KIND_CHAT}.content").alias("content"),
    )


# White space in the Unicode sense.
_WS = (r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
       r"\x{202F}\x{205F}\x{3000}]")


def _between(tag: str, otherwise: str) -> str:
    start, end = f"<{tag}>", f"</{tag}>"
    return (
        f"CASE WHEN strpos(flat, '{start}') = 0 THEN {otherwise} "
        f"WHEN strpos(flat, '{end}') >= strpos(flat, '{start}') + {len(start)} THEN "
        f"regexp_replace(substr(flat, strpos(flat, '{start}') + {len(start)}, "
        f"strpos(flat, '{end}') - strpos(flat, '{start}') - {len(start)}), "
        f"'^{_WS}+|{_WS}+$', '', 'g') ELSE replace(flat, '{start}', '') END"
    )


_USER = _between("user_input", "flat")
_ASSISTANT = _between("assistant_response", "trim(flat, '\"')")
_SPOKEN = f"CASE WHEN role = 'user' THEN {_USER} ELSE {_ASSISTANT} END"
TAGGED = f"{I.TAGGED},\nflats AS (SELECT *, replace(text, chr(10), ' ') AS flat FROM tagged)"
LINES = (
    f"{TAGGED},\nlines AS (SELECT session_id, turn, concat(CASE WHEN role = 'user' THEN 'user: ' "
    f"ELSE 'assistant: ' END, {_SPOKEN}, chr(10)) AS line FROM flats),\n"
    "firsts AS (SELECT session_id, min(turn) AS turn, line FROM lines GROUP BY session_id, line)"
)


# ------------------------------------------------- operator tables of prompts

# A prompt per customer: complete, without blank line, without block, or with
# masks only.
_N = "chr(10)"
_BODY = (
    f"concat('{{', {_N}, "
    f"CASE WHEN k % 5 = 3 THEN '' ELSE concat('\"DEFAULT\": {{\"type\": \"replace\", \"new_value\": \"[REDACTED]\"}},', {_N}, "
    f"'\"TEAM\": {{\"type\": \"replace\", \"new_value\": \"[TEAM_', CAST(k % 7 AS STRING), ']\"}},', {_N}, "
    f"'\"AGAIN\": {{\"type\": \"replace\", \"new_value\": \"[REDACTED]\"}},', {_N}) END, "
    "'\"PHONE_NUMBER\": {\"type\": \"mask\", \"masking_char\": \"*\", \"chars_to_mask\": ', "
    f"CAST(k % 9 + 1 AS STRING), ', \"from_end\": true}},', {_N}, '}}', {_N})"
).replace("{{", "{").replace("}}", "}")
_OPS = (
    f"concat('Intro ', name, {_N}, 'OPERATORS = ', {_BODY}, "
    f"CASE WHEN k % 5 = 1 THEN '' ELSE {_N} END, 'Rules for {{x}}.')"
).replace("{{x}}", "{x}")
PROMPT = f"CASE WHEN k % 5 = 2 THEN concat('No table for ', name) ELSE {_OPS} END"


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS name").selectExpr(
        "k", f"{PROMPT} AS prompt"
    )


# The SQL knows what was planted and reads no prompt.
PROMPTS = f"""prompts AS (SELECT c_custkey AS k FROM customer),
blocks AS (SELECT k, CASE WHEN k % 5 IN (1, 2) THEN NULL ELSE concat({_BODY}, {_N}) END AS block FROM prompts),
planted AS (SELECT k, unnest([
    {{'name': 'DEFAULT', 'new_value': '[REDACTED]'}},
    {{'name': 'TEAM', 'new_value': concat('[TEAM_', k % 7, ']')}},
    {{'name': 'AGAIN', 'new_value': '[REDACTED]'}},
    {{'name': 'PHONE_NUMBER', 'new_value': NULL}}]) AS a FROM blocks WHERE block IS NOT NULL),
actions AS (SELECT k, a.name AS name, a.new_value AS new_value,
    CASE WHEN a.name = 'PHONE_NUMBER' THEN 'mask' ELSE 'replace' END AS type,
    CASE WHEN a.name = 'PHONE_NUMBER' THEN '*' END AS masking_char,
    CASE WHEN a.name = 'PHONE_NUMBER' THEN CAST(k % 9 + 1 AS INT) END AS chars_to_mask,
    CASE WHEN a.name = 'PHONE_NUMBER' THEN true END AS from_end
  FROM planted WHERE k % 5 <> 3 OR a.name = 'PHONE_NUMBER')"""


def operators_load(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt files written to the shared folder and read back as operator tables."""
    path = I.shared_folder(spark, "prompts")
    optable.write_prompts(prompts(spark, sf), path, ["k"])
    read = optable.read_keyed_prompts(spark, path, "k BIGINT")
    return optable.operators_table(read, ["k"]).select("k", "name", "type", "new_value")


# -------------------------------------------------------------- compression

def brief_input(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "documents").select("doc_id", "text")


def brevity_words(spark: SparkSession, sf: str) -> DataFrame:
    return brief_input(spark, sf).select(
        "doc_id", F.posexplode(brevity.words(F.col("text"))).alias("pos", "word")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def brevity_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = brevity.with_vocabulary(brief_input(spark, sf)).select("doc_id", F.explode("vocabulary").alias("v"))
    return rows.selectExpr("doc_id", "v.word AS word", "CAST(size(v.places) AS BIGINT) AS n")


def brevity_dict(spark: SparkSession, sf: str) -> DataFrame:
    rows = brevity.with_dictionary(brief_input(spark, sf)).select("doc_id", F.explode("dictionary").alias("d"))
    return rows.selectExpr("doc_id", "d.abbr AS abbr", "d.word AS word")


def brevity_text(spark: SparkSession, sf: str) -> DataFrame:
    return brief_input(spark, sf).select("doc_id", brevity.brief(F.col("text")).alias("brief"))


WORDS = f"""raw_words AS (SELECT doc_id, generate_subscripts(w, 1) AS i,
    lower(regexp_replace(unnest(w), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')) AS word
  FROM (SELECT doc_id, regexp_split_to_array(text, {q(_WS + '+')}) AS w FROM documents)),
words AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, word
  FROM raw_words WHERE word <> ''),
counts AS (SELECT doc_id, word, count(*) AS n, min(pos) AS first_pos FROM words GROUP BY doc_id, word),
dict AS (SELECT doc_id, word, concat(substr(word, 1, 1), row_number() OVER (
    PARTITION BY doc_id, substr(word, 1, 1) ORDER BY first_pos)) AS abbr
  FROM counts WHERE n > 1 AND NOT regexp_matches(word, '^[0-9]'))"""

QUERIES = {
    "chat_only": chat_only,
    "flatten_newlines": lambda spark, sf: _tagged(spark, sf).select("session_id", "turn", "flat"),
    "role_label": lambda spark, sf: I.tagged(spark, sf).select(
        "session_id", "turn", T.role_label(F.col("role")).alias("label")),
    "user_tag": _said(True, "user_input"),
    "user_tag_open": user_tag_open,
    "assistant_tag": _said(False, "assistant_response"),
    "assistant_quotes": assistant_quotes,
    "dedup_lines": dedup_lines,
    "transcript": lambda spark, sf: T.transcripts(I.tagged(spark, sf)),
    "transcript_parts": lambda spark, sf: T.transcript_parts(I.tagged(spark, sf)),
    "operators_block": lambda spark, sf: prompts(spark, sf).select(
        "k", optable.operators_block(F.col("prompt")).alias("block")),
    "operators_table": lambda spark, sf: optable.operators_table(prompts(spark, sf), ["k"]),
    "operators_load": operators_load,
    "valid_tags": lambda spark, sf: prompts(spark, sf).select(
        "k", F.array_join(F.array_sort(optable.valid_tags(F.col("prompt"))), ",").alias("tags")),
    "brevity_words": brevity_words,
    "brevity_counts": brevity_counts,
    "brevity_dict": brevity_dict,
    "brevity_text": brevity_text,
}

_ROWS = f"WITH {TAGGED}\nSELECT session_id, turn, "
ORACLES = {
    "chat_only": (
        f"WITH {I.ENVELOPES},\nplaced AS (SELECT *, row_number() OVER (PARTITION BY session_id, part "
        "ORDER BY turn, slot) - 1 AS pos FROM log_entries)\n"
        "SELECT session_id, part, delivery, pos, json_extract_string(entry, '$.role') AS role, "
        "json_extract_string(entry, '$.content') AS content FROM placed JOIN envelopes "
        "USING (session_id, part) JOIN log_bodies USING (session_id, part) "
        "WHERE slot = 4 AND payload = body"
    ),
    "flatten_newlines": f"{_ROWS} flat FROM flats",
    "role_label": f"{_ROWS} CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS label FROM flats",
    "user_tag": f"{_ROWS} {_USER} AS said FROM flats WHERE role = 'user'",
    "user_tag_open": (
        f"{_ROWS} replace(flat, '<user_input>', '') AS said FROM flats WHERE role = 'user' "
        "AND contains(flat, '<user_input>') AND NOT contains(flat, '</user_input>')"),
    "assistant_tag": f"{_ROWS} {_ASSISTANT} AS said FROM flats WHERE role <> 'user'",
    "assistant_quotes": (
        f"{_ROWS} trim(flat, '\"') AS said FROM flats WHERE role <> 'user' "
        "AND NOT contains(flat, '<assistant_response>')"),
    "dedup_lines": f"WITH {LINES}\nSELECT * FROM firsts",
    "transcript": (
        f"WITH {LINES}\nSELECT session_id, string_agg(line, '' ORDER BY turn, line) AS transcript "
        "FROM firsts GROUP BY session_id"),
    "transcript_parts": (
        f"WITH {LINES}\nSELECT session_id, turn // 256 AS part, "
        "string_agg(line, '' ORDER BY turn, line) AS transcript FROM firsts GROUP BY session_id, turn // 256"),
    "operators_block": f"WITH {PROMPTS}\nSELECT k, block FROM blocks",
    "operators_table": (
        f"WITH {PROMPTS}\nSELECT k, name, type, new_value, masking_char, chars_to_mask, from_end FROM actions"),
    "operators_load": f"WITH {PROMPTS}\nSELECT k, name, type, new_value FROM actions",
    "valid_tags": (
        f"WITH {PROMPTS}\nSELECT k, t.tags FROM prompts LEFT JOIN (SELECT k, "
        "string_agg(DISTINCT new_value, ',' ORDER BY new_value) AS tags FROM actions "
        "WHERE new_value IS NOT NULL GROUP BY k) t USING (k)"),
    "brevity_words": f"WITH {WORDS}\nSELECT * FROM words",
    "brevity_counts": f"WITH {WORDS}\nSELECT doc_id, word, n FROM counts",
    "brevity_dict": f"WITH {WORDS}\nSELECT doc_id, abbr, word FROM dict",
    "brevity_text": (
        f"WITH {WORDS}\nSELECT d.doc_id, coalesce(t.brief, '') AS brief FROM documents d LEFT JOIN "
        "(SELECT w.doc_id, string_agg(coalesce(abbr, word), ' ' ORDER BY pos) AS brief "
        "FROM words w LEFT JOIN dict USING (doc_id, word) GROUP BY w.doc_id) t USING (doc_id)"),
}
