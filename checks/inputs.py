"""Inputs derived from the driver tables, in Spark and in DuckDB SQL.

``turns``        conversations, and documents as sessions of eight turns
``identifiers``  sentences with every kind of personal data, per customer
``corpus``       both of them
``tagged``       turns wrapped in tags or quotes, first turn repeated
``envelopes``    one message per 64 turns of a session, some of them faulty
``responses``    one model response per session, of eight sorts

Session numbers are kept apart by their remainder modulo three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.sources.tables import read_table, shared_folder, spread_if_small


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread_if_small(read_table(spark, sf, name))


# ---------------------------------------------------------------- turns

def turns(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations").selectExpr(
        "conv_id * 3 AS session_id", "turn", "role", "text"
    )
    docs = table(spark, sf, "documents").selectExpr(
        "(doc_id DIV 8) * 3 + 1 AS session_id", "doc_id % 8 AS turn",
        "CASE WHEN doc_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role", "text",
    )
    return said.unionByName(docs)


TURNS = """turns AS (
  SELECT conv_id * 3 AS session_id, turn, role, text FROM conversations
  UNION ALL
  SELECT (doc_id // 8) * 3 + 1, doc_id % 8,
         CASE WHEN doc_id % 2 = 0 THEN 'user' ELSE 'assistant' END, text FROM documents)"""


# ---------------------------------------------------------- identifiers

def _pad(expr: str, n: int) -> str:
    return f"lpad(CAST(({expr}) % {10 ** n} AS STRING), {n}, '0')"


def _digit(text: str, i: int) -> str:
    return f"CAST(substr({text}, {i + 1}, 1) AS BIGINT)"


def _luhn_digit(base: str, n: int) -> str:
    """Check digit to append to ``base``, a string of ``n`` digits."""
    terms = []
    for i in range(n):
        d = _digit(base, i)
        doubled = (n - i) % 2 == 1
        terms.append(f"(2 * {d} - CASE WHEN {d} > 4 THEN 9 ELSE 0 END)" if doubled else d)
    return f"CAST((10 - ({' + '.join(terms)}) % 10) % 10 AS STRING)"


def _aba_digit(base: str) -> str:
    total = " + ".join(f"{(3, 7, 1)[i % 3]} * {_digit(base, i)}" for i in range(8))
    return f"CAST((10 - ({total}) % 10) % 10 AS STRING)"


def _spell(text: str, n: int, sep: str = " ") -> str:
    return "concat(" + f", '{sep}', ".join(f"substr({text}, {i + 1}, 1)" for i in range(n)) + ")"


# First step: numbers without check digit. Second step: with it.
_BASES = {
    "card15": f"concat('4', {_pad('k * 7919', 14)})",
    "sin8": f"concat('1', {_pad('k * 31', 7)})",
    "aba8": f"concat('0', {_pad('k * 17', 7)})",
    "bban": f"concat('37', {_pad('k * 1009', 16)})",
    "phone4": _pad("k", 4),
    "ten": f"concat('6', {_pad('k * 13', 9)})",
}
_NUMBERS = {
    "card": f"concat(card15, {_luhn_digit('card15', 15)})",
    "sin9": f"concat(sin8, {_luhn_digit('sin8', 8)})",
    "aba9": f"concat(aba8, {_aba_digit('aba8')})",
    "iban": "concat('DE', lpad(CAST(98 - (CAST(bban AS BIGINT) % 97 * 1000000 + 131400) % 97 "
            "AS STRING), 2, '0'), bban)",
    "badiban": "concat('DE', lpad(CAST((98 - (CAST(bban AS BIGINT) % 97 * 1000000 + 131400) % 97) "
               "% 97 + 1 AS STRING), 2, '0'), bban)",
}
_K = "CAST(k AS STRING)"
_CARD4 = "substr(card, 1, 4), '{s}', substr(card, 5, 4), '{s}', substr(card, 9, 4), '{s}', substr(card, 13, 4)"
_BADCARD = "substr(card, 1, 15), CAST((CAST(substr(card, 16, 1) AS BIGINT) + 1) % 10 AS STRING)"
_NAMES = ("Anna Maria Lopez", "John Smith", "Zoé Dupont", "Jean-Luc O'Neill", "Li Wei")
_NAME = "CASE k % 5 " + " ".join(
    f"WHEN {i} THEN '" + n.replace("'", "{q}") + "'" for i, n in enumerate(_NAMES)
) + " END"
# One sentence per turn, as arguments of ``concat``. Portable SQL, but for the
# quote inside a name, which the two dialects escape in different ways.
_SENTENCES = (
    f"'Write to user', {_K}, '@mail.com today.'",
    "'Call me at +1 (415) 555-', phone4, '.'",
    f"'My card is {{card}} thanks'".replace("{card}", "', " + _CARD4.format(s=" ") + ", '"),
    f"'Order {{card}} shipped'".replace("{card}", "', " + _BADCARD + ", '"),
    f"'Paid with ', {_CARD4.format(s='-')}, ' yesterday, exp date: 0', CAST(k % 9 + 1 AS STRING), '/2', CAST(k % 10 AS STRING)",
    f"'cvv is ', CAST(k % 900 + 100 AS STRING), ', my pin is ', {_pad('k', 4)}, ' and pin 12345 is not one'",
    "'IBAN ', iban, ' is mine'",
    "'IBAN ', substr(iban, 1, 4), ' ', substr(iban, 5, 4), ' ', substr(iban, 9, 4), ' ', substr(iban, 13, 4), ' ', substr(iban, 17, 4), ' ', substr(iban, 21, 2), '.'",
    "'IBAN ', badiban, ' is wrong'",
    f"'SWIFT code: DEUTDE', {_pad('k', 2)}, ' or BIC CHASUS33XXX, swift delivery'",
    f"'VIN 1HGCM82633A', {_pad('k', 6)}, ' and 1HGCM82633A', {_pad('k', 7)}",
    f"'My account number is 1', {_pad('k', 9)}, ' routing number is ', aba9, ', aba 123456789'",
    f"'ITIN 9', {_pad('k', 2)}, '-7', CAST(k % 10 AS STRING), '-', {_pad('k', 4)}, ' and SSN: ', CAST(k % 700 + 100 AS STRING), '-', {_pad('k', 2)}, '-', {_pad('k * 3', 4)}",
    f"'social security number is 12', {_pad('k', 7)}, '; plain 12', {_pad('k', 7)}",
    "'health card number is ', substr(ten, 1, 4), ' ', substr(ten, 5, 3), ' ', substr(ten, 8, 3)",
    "'SIN: ', substr(sin9, 1, 3), ' ', substr(sin9, 4, 3), ' ', substr(sin9, 7, 3), ' and sin 123 456 789'",
    f"'See https://shop', {_K}, '.example.com/a?b=', {_K}, ', or www.example.org/x.'",
    "'My name is ', who, '. This is Camera'",
    "'Order of ', name, ' from ', nation, ' and from ASIA'",
    f"'I live in Springfield, ', CAST(k % 900 + 1 AS STRING), ' Main Street, zip code is ', {_pad('k', 5)}",
    f"'Host 10.', CAST(k % 256 AS STRING), '.0.1 not 1.2.3.4.5 nor 300.1.1.1, passport number AB', {_pad('k', 6)}, ', username: user_', {_K}",
    f"'token = \"tok_', {_pad('k * 7', 14)}, '\" end'",
    f"'spelled ', {_spell('card', 16)}, ' and ', {_spell('ten', 10, '-')}, ' and ', {_spell('sin9', 9, '.')}",
    "'I moved to English, travel to Kitchen light; the thermostat reads 21 degrees at 10:30'",
    f"'Sure, ', who, ', I will write to user', {_K}, '@mail.com or call +1 (415) 555-', phone4",
    f"'Long: ', repeat('first.second_', 6), {_K}, '@', repeat('sub.', 12), 'example.org, end'",
    f"'apart ', {_spell('card', 16)}, ' ', {_spell('ten', 10)}, ' and ', {_spell('card15', 15, '-')}, '-', CAST((CAST(substr(card, 16, 1) AS BIGINT) + 1) % 10 AS STRING)",
    "'My name is Anna Light. This is My Kitchen Light, this is The Front Door and I am Zoe ', chr(CAST(65 + k % 26 AS INT)), ' Lamp'",
)


def identifiers(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "customer").selectExpr(
        "c_custkey AS k", "c_name AS name", "concat('NATION_', CAST(c_nationkey AS STRING)) AS nation",
        _NAME.replace("{q}", "\\'") + " AS who",
    )
    numbers = base.selectExpr("*", *(f"{e} AS {c}" for c, e in _BASES.items())).selectExpr(
        "*", *(f"{e} AS {c}" for c, e in _NUMBERS.items())
    )
    texts = ", ".join(f"concat({s})" for s in _SENTENCES)
    return numbers.selectExpr("k", f"posexplode(array({texts})) AS (turn, text)").selectExpr(
        "k * 3 + 2 AS session_id", "CAST(turn AS BIGINT) AS turn", "'user' AS role", "text"
    )


def _columns(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in exprs.items())


IDENTIFIERS = f"""id_base AS (
  SELECT c_custkey AS k, c_name AS name,
         concat('NATION_', CAST(c_nationkey AS STRING)) AS nation,
         {_NAME.replace("{q}", "''")} AS who FROM customer),
id_bases AS (SELECT *, {_columns(_BASES)} FROM id_base),
id_numbers AS (SELECT *, {_columns(_NUMBERS)} FROM id_bases),
identifiers AS (
  SELECT k * 3 + 2 AS session_id, CAST(generate_subscripts(texts, 1) - 1 AS BIGINT) AS turn,
         'user' AS role, unnest(texts) AS text
  FROM (SELECT k, [{', '.join(f"concat({s})" for s in _SENTENCES)}] AS texts FROM id_numbers))"""


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return turns(spark, sf).unionByName(identifiers(spark, sf))


CORPUS = f"""{TURNS},
{IDENTIFIERS},
corpus AS (SELECT * FROM turns UNION ALL SELECT * FROM identifiers)"""


# --------------------------------------------------------------- tagged

_WRAPPED = """CASE turn % 4
  WHEN 0 THEN concat('before <', tag, '> ', text, ' </', tag, '> after')
  WHEN 1 THEN concat('before <', tag, '> middle <', tag, '>', text)
  WHEN 2 THEN concat('"', text, '""')
  ELSE text END"""
_TAG = "CASE WHEN role = 'user' THEN 'user_input' ELSE 'assistant_response' END"


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    df = turns(spark, sf).selectExpr("*", f"{_TAG} AS tag").selectExpr(
        "session_id", "turn", "role", f"{_WRAPPED} AS text"
    )
    # The first turn comes again at the end of its session.
    return df.selectExpr(
        "session_id", "role", "text",
        "explode(CASE WHEN turn = 0 THEN array(turn, turn + 1000) ELSE array(turn) END) AS turn",
    ).select("session_id", "turn", "role", "text")


TAGGED = f"""{TURNS},
wrapped AS (SELECT session_id, turn, role, {_WRAPPED} AS text
            FROM (SELECT *, {_TAG} AS tag FROM turns)),
tagged AS (SELECT * FROM wrapped
           UNION ALL SELECT session_id, turn + 1000, role, text FROM wrapped WHERE turn = 0)"""


# ------------------------------------------------------------ envelopes

PART = 64
TENANT, APPLICATION, SUBJECT = "acme", "chat", "mask"

_FAULTY = """CASE
  WHEN seq % 11 = 0 THEN substr(body, 1, length(body) - 1)
  WHEN seq % 13 = 0 THEN '{}'
  WHEN seq % 17 = 0 THEN '[]'
  WHEN seq % 19 = 0 THEN concat(substr(body, 1, length(body) - 1), ',{"role":"user"}]')
  WHEN seq % 23 = 0 THEN ''
  ELSE body END"""


def log_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Turns with the number of the part of their session."""
    return turns(spark, sf).withColumn("part", F.floor(F.col("turn") / PART).cast("bigint"))


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Messages; a part has at most 64 turns, so a group is always small."""
    call = F.struct(
        F.col("turn").cast("int").alias("index"),
        F.struct(F.lit("lookup").alias("name"),
                 F.to_json(F.struct(F.col("text").alias("q"))).alias("arguments")).alias("function"),
        F.concat(F.lit("call_"), F.col("turn").cast("string")).alias("id"),
        F.lit("function").alias("type"),
    )
    calls = F.when(F.col("turn") % 3 == 2, F.array(call))
    message = F.struct("role", F.col("text").alias("content"), calls.alias("tool_calls"),
                       F.col("turn").cast("int").alias("turn"))
    asked = F.struct("role", F.col("text").alias("content"), F.array(call).alias("tool_calls"))
    interaction = F.struct(F.struct(
        F.struct(F.array(asked).alias("chat_history"),
                 F.array(F.struct(F.lit("lookup").alias("name"))).alias("functions"),
                 F.lit("m").alias("model"), F.lit("c").alias("gpt_client")).alias("request"),
        F.struct(F.lit("agent").alias("agent"), asked.alias("message")).alias("response"),
        F.lit(1.5).alias("time"),
    ).alias("chat_gpt"))
    first = F.col("turn") % PART == 0
    head = F.array(
        F.lit('{"architecture_type":"Neocortex","ignored":1}'),
        F.lit('{"tool_calls":[{"turn":1,"tool_calls":["call_2"]}]}'),
        F.lit('{"time_summary_s":{"total_function_times":{"timestamp":1.5,"retrieve_state":0,'
              '"get_rules":0,"get_groups":0,"get_devices":0,"get_response":2},'
              '"total_request_time":3.5}}'),
        F.to_json(interaction),
    )
    entries = F.when(first, F.concat(head, F.array(F.to_json(message)))).otherwise(
        F.array(F.to_json(message)))
    logs = (
        log_parts(spark, sf).withColumn("entries", entries)
        .groupBy("session_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "entries"))).alias("e"))
        .select("session_id", "part", F.concat(
            F.lit("["),
            F.array_join(F.flatten(F.transform("e", lambda x: x["entries"])), ","),
            F.lit("]"),
        ).alias("body"))
    )
    named = logs.selectExpr(
        "session_id", "part", "session_id * 1000003 + part AS seq", "body"
    ).selectExpr("*", f"{_FAULTY} AS payload")
    return named.selectExpr(
        "session_id", "part",
        "CASE WHEN seq % 9 = 0 THEN NULL ELSE seq END AS seq",
        "CASE WHEN seq % 9 = 0 THEN NULL ELSE timestamp_seconds(1704067200 + seq % 1000000) END AS published",
        f"concat('{TENANT}.{APPLICATION}.', CASE WHEN seq % 7 = 0 THEN 'other' ELSE '{SUBJECT}' END) AS subject",
        "CASE WHEN seq % 10 = 0 THEN NULL WHEN seq % 10 = 5 THEN map('session_log_name', '') "
        "ELSE map('session_log_name', concat('log-', CAST(session_id AS STRING), '-', CAST(part AS STRING))) END AS headers",
        "payload",
        "explode(sequence(1, CASE WHEN seq % 12 = 1 THEN 2 ELSE 1 END)) AS delivery",
    )


ENVELOPES = f"""{TURNS},
log_parts AS (SELECT *, turn // {PART} AS part,
    json_object('index', turn, 'function', json_object('name', 'lookup', 'arguments',
      CAST(json_object('q', text) AS VARCHAR)), 'id', concat('call_', turn), 'type', 'function') AS call
  FROM turns),
log_entries AS (
  SELECT session_id, part, turn, 4 AS slot,
    CASE WHEN turn % 3 = 2
      THEN json_object('role', role, 'content', text, 'tool_calls', json_array(call), 'turn', turn)
      ELSE json_object('role', role, 'content', text, 'turn', turn) END AS entry FROM log_parts
  UNION ALL
  SELECT session_id, part, turn, slot, entry FROM (
    SELECT session_id, part, turn, unnest([0, 1, 2, 3]) AS slot, unnest([
      CAST('{{"architecture_type":"Neocortex","ignored":1}}' AS JSON),
      CAST('{{"tool_calls":[{{"turn":1,"tool_calls":["call_2"]}}]}}' AS JSON),
      CAST('{{"time_summary_s":{{"total_function_times":{{"timestamp":1.5,"retrieve_state":0,"get_rules":0,"get_groups":0,"get_devices":0,"get_response":2}},"total_request_time":3.5}}}}' AS JSON),
      json_object('chat_gpt', json_object(
        'request', json_object('chat_history', json_array(json_object('role', role, 'content', text,
           'tool_calls', json_array(call))), 'functions', json_array(json_object('name', 'lookup')),
           'model', 'm', 'gpt_client', 'c'),
        'response', json_object('agent', 'agent', 'message', json_object('role', role, 'content', text,
           'tool_calls', json_array(call))), 'time', 1.5))]) AS entry
    FROM log_parts WHERE turn % {PART} = 0)),
log_bodies AS (
  SELECT session_id, part, session_id * 1000003 + part AS seq,
    concat('[', string_agg(CAST(entry AS VARCHAR), ',' ORDER BY turn, slot), ']') AS body
  FROM log_entries GROUP BY session_id, part),
envelopes AS (
  SELECT session_id, part, CASE WHEN seq % 9 = 0 THEN NULL ELSE seq END AS seq,
    CASE WHEN seq % 9 = 0 THEN NULL ELSE 1704067200 + seq % 1000000 END AS published_s,
    concat('{TENANT}.{APPLICATION}.', CASE WHEN seq % 7 = 0 THEN 'other' ELSE '{SUBJECT}' END) AS subject,
    CASE WHEN seq % 10 = 0 THEN NULL WHEN seq % 10 = 5 THEN ''
      ELSE concat('log-', session_id, '-', part) END AS header,
    {_FAULTY} AS payload,
    unnest(range(1, CASE WHEN seq % 12 = 1 THEN 3 ELSE 2 END)) AS delivery
  FROM log_bodies)"""


# ------------------------------------------------------------ responses

def responses(spark: SparkSession, sf: str) -> DataFrame:
    """One recorded-style response per session, its sort given by the session."""
    s = F.col("session_id").cast("string")
    sort = F.col("sort")
    head = F.col("head")

    def found(*pairs) -> Column:
        return F.to_json(F.create_map(F.lit("redactions"), F.create_map(*pairs)))

    tag = F.lit
    content = (
        F.when(sort == 0, found(head, tag("[PERSON]"), F.concat(F.lit("desk"), s, F.lit("@corp.example")),
                                F.concat(F.lit("desk"), s, F.lit("****"))))
        .when(sort == 1, found(tag("[PERSON]"), head, F.concat(F.lit("acct"), s, F.lit("****")),
                               F.concat(F.lit("acct"), s, F.lit("0042"))))
        .when(sort == 2, found(head, tag("[STRANGE]"), F.concat(F.lit("x"), s), tag("[LOCATION]")))
        .when(sort == 3, F.concat(F.lit("```json\n"), found(head, tag("[PERSON]")), F.lit("\n```")))
        .when(sort == 6, F.concat(
            F.lit('{"redactions":{"n":5,"z":null,"q'), s, F.lit('":"[URL]","[PIN]":"q'), s,
            F.lit('"}}')))
        .when(sort == 7, found(tag("[PERSON]"), F.concat(F.lit("v"), s), F.concat(F.lit("v"), s),
                               tag("[LOCATION]"), F.lit("same"), F.lit("same"), tag("[VIN]"), F.lit("")))
    )
    answer = F.to_json(F.struct(F.struct(content.alias("content")).alias("message")))
    more = F.concat(F.lit(',{"message":{"content":"{\\"redactions\\":{\\"w\\":\\"[PIN]\\"}}"}}'))
    body = (
        F.when(sort == 4, F.lit('{"message":{}}'))
        .when(sort == 5, F.lit('{"message":{"content":5}}'))
        .when(sort == 7, F.concat(answer, more))
        .otherwise(answer)
    )
    return (
        turns(spark, sf).where(F.col("turn") == 0)
        .select("session_id", (F.floor(F.col("session_id") / 3) % 8).alias("sort"),
                F.concat(F.lit("h"), F.col("text")).alias("head"))
        .select("session_id", F.concat(F.lit('{"id":"r","choices":['), body, F.lit("]}")).alias("response"))
    )


RESPONSES = f"""{TURNS},
response_heads AS (SELECT session_id, (session_id // 3) % 8 AS sort,
    concat('h', text) AS head FROM turns WHERE turn = 0),
response_contents AS (SELECT session_id, sort, CASE sort
    WHEN 0 THEN CAST(json_object('redactions', json_object(head, '[PERSON]',
        concat('desk', session_id, '@corp.example'), concat('desk', session_id, '****'))) AS VARCHAR)
    WHEN 1 THEN CAST(json_object('redactions', json_object('[PERSON]', head,
        concat('acct', session_id, '****'), concat('acct', session_id, '0042'))) AS VARCHAR)
    WHEN 2 THEN CAST(json_object('redactions', json_object(head, '[STRANGE]',
        concat('x', session_id), '[LOCATION]')) AS VARCHAR)
    WHEN 3 THEN concat('```json', chr(10), CAST(json_object('redactions',
        json_object(head, '[PERSON]')) AS VARCHAR), chr(10), '```')
    WHEN 6 THEN concat('{{"redactions":{{"n":5,"z":null,"q', session_id,
        '":"[URL]","[PIN]":"q', session_id, '"}}}}')
    WHEN 7 THEN CAST(json_object('redactions', json_object('[PERSON]', concat('v', session_id),
        concat('v', session_id), '[LOCATION]', 'same', 'same', '[VIN]', '')) AS VARCHAR)
    END AS content FROM response_heads),
responses AS (SELECT session_id, concat('{{"id":"r","choices":[', CASE sort
    WHEN 4 THEN '{{"message":{{}}}}'
    WHEN 5 THEN '{{"message":{{"content":5}}}}'
    WHEN 7 THEN concat(CAST(json_object('message', json_object('content', content)) AS VARCHAR),
        ',{{"message":{{"content":"{{\\"redactions\\":{{\\"w\\":\\"[PIN]\\"}}}}"}}}}')
    ELSE CAST(json_object('message', json_object('content', content)) AS VARCHAR) END, ']}}') AS response
  FROM response_contents)"""
