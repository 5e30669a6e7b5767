"""Detection by rules and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from veil.functions import masking
from veil.operators import detect as D
from veil.operators.gazetteer import match_terms

from veil.schema import KEEP_SEPARATORS, OPERATORS

_KEYS = {
    "detect_email": "EMAIL_ADDRESS", "detect_url": "URL", "detect_iban": "IBAN_CODE",
    "detect_vin": "VIN", "detect_card": "CREDIT_CARD_NUMBER", "detect_expiry": "CREDIT_CARD_EXPIRY",
    "detect_cvv": "CREDIT_CARD_CVV", "detect_pin": "PIN", "detect_itin": "US_ITIN",
    "detect_ssn": "US_SSN", "detect_ca_sin": "CA_SIN", "detect_us_routing": "US_BANK_ROUTING_NUMBER",
    "detect_ca_health": "CA_HEALTH_NUMBER", "detect_us_account": "US_BANK_ACCOUNT_NUMBER",
    "detect_swift": "SWIFT_CODE", "detect_phone": "PHONE_NUMBER", "detect_default": "DEFAULT",
}


def _operator(name: str):
    return lambda spark, sf: D.detect_operator(I.corpus(spark, sf), name)


def terms(spark: SparkSession, sf: str, *sources: str) -> DataFrame:
    """Word lists of names and places from the driver tables."""
    lists = {
        "customer": ("c_name", "PERSON"), "supplier": ("s_name", "PERSON"),
        "nation": ("n_name", "LOCATION"), "region": ("r_name", "LOCATION"),
    }
    parts = [
        I.read_table(spark, sf, t).selectExpr(f"{lists[t][0]} AS term", f"'{lists[t][1]}' AS operator")
        for t in sources or lists
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


TERMS = """terms AS (
  SELECT c_name AS term, 'PERSON' AS operator FROM customer
  UNION ALL SELECT s_name, 'PERSON' FROM supplier
  UNION ALL SELECT n_name, 'LOCATION' FROM nation
  UNION ALL SELECT r_name, 'LOCATION' FROM region)"""

# Word n-grams of capitalised runs, joined with the lists.
_RUN = r"(?:^|[^\p{L}\p{N}#_'-])(\p{Lu}[\p{L}\p{N}#_'-]*(?: \p{Lu}[\p{L}\p{N}#_'-]*)*)"
GRAMS = f"""runs AS (SELECT session_id, string_split(unnest(regexp_extract_all(text, {S.q(_RUN)}, 1)), ' ') AS w
  FROM corpus),
starts AS (SELECT session_id, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
grams AS (
  SELECT DISTINCT session_id, array_to_string(w[i:i + n - 1], ' ') AS value
  FROM (SELECT session_id, w, i, unnest([1, 2, 3]) AS n FROM starts) WHERE i + n - 1 <= len(w)),
matched AS (SELECT DISTINCT session_id, value, operator FROM grams JOIN terms ON value = term)"""


def _with_terms(name: str, *sources: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        corpus = I.corpus(spark, sf)
        cued = D.detect_operator(corpus, name).select("session_id", "value")
        listed = match_terms(corpus, terms(spark, sf, *sources)).select("session_id", "value")
        return cued.unionByName(listed).distinct()
    return query


def _with_terms_sql(name: str) -> str:
    return (
        f"WITH {I.CORPUS},\n{TERMS},\n{GRAMS}\n"
        f"SELECT session_id, value FROM ({S.operator_hits(name)}) "
        f"UNION SELECT session_id, value FROM matched WHERE operator = '{name}'"
    )


def spaced_digits(spark: SparkSession, sf: str) -> DataFrame:
    return D.detect_spaced_digits(I.corpus(spark, sf))


def detect_all(spark: SparkSession, sf: str) -> DataFrame:
    corpus = I.corpus(spark, sf)
    return D.detect(corpus, extra=match_terms(corpus, terms(spark, sf)))


def all_rows(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """Every candidate of all or of the named operators, priorities not settled."""
    texts, scan = D.scanned(I.corpus(spark, sf))
    operators = [op for op in OPERATORS if not names or op.name in names]
    return texts.select("session_id", F.explode(D.candidates(scan, operators)).alias("h")).selectExpr(
        "session_id", "h.value AS value", "h.priority AS priority"
    )


def priority(spark: SparkSession, sf: str) -> DataFrame:
    return D.best_operator(all_rows(spark, sf)).select("session_id", "value", "operator")


def allow_list(spark: SparkSession, sf: str) -> DataFrame:
    """Cue-based candidates before and after the allow list, region names allowed too."""
    corpus = I.corpus(spark, sf)
    found = D.detect_operator(corpus, "PERSON")
    for name in ("LOCATION", "DEFAULT"):
        found = found.unionByName(D.detect_operator(corpus, name))
    extra = I.read_table(spark, sf, "region").selectExpr("r_name AS value")
    listed = match_terms(corpus, terms(spark, sf, "nation", "region")).selectExpr(
        "session_id", "cast(-1 as bigint) AS turn", "value")
    return D.apply_allow_list(found.unionByName(listed), extra).distinct()


def _acted(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """Distinct candidates of some operators with what their action makes of them."""
    rows = all_rows(spark, sf, *names).select("value", "priority").distinct()
    ranks = {op.priority: op.name for op in OPERATORS}
    operator = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col("priority")]
    rows = rows.withColumn("operator", operator)
    return rows.select(
        "operator", "value", masking.replacement(F.col("operator"), F.col("value")).alias("replacement")
    )


_REPLACING = tuple(op.name for op in OPERATORS if op.type == "replace")
_ACTED_SQL = (
    f"WITH {I.CORPUS},\ncands AS ({S.candidates()})\n"
    f"SELECT operator, value, {S.replacement('operator', 'value')} AS replacement FROM "
    f"(SELECT DISTINCT {S.NAMES}[priority] AS operator, value FROM cands) WHERE operator IN ({{names}})"
)


def _names(*names: str) -> str:
    return _ACTED_SQL.replace("{names}", ", ".join(S.q(n) for n in names))


QUERIES = {
    **{key: _operator(name) for key, name in _KEYS.items()},
    "detect_person": _with_terms("PERSON", "customer", "supplier"),
    "detect_location": _with_terms("LOCATION", "nation", "region"),
    "detect_spaced_digits": spaced_digits,
    "detect_priority": priority,
    "allow_list": allow_list,
    "detect_all": detect_all,
    "act_replace": lambda spark, sf: _acted(spark, sf, *_REPLACING),
    "act_mask": lambda spark, sf: _acted(spark, sf, "EMAIL_ADDRESS"),
    "act_mask_sep": lambda spark, sf: _acted(spark, sf, *KEEP_SEPARATORS),
}

_REGION = "(SELECT lower(r_name) FROM region)"
ORACLES = {
    **{key: f"WITH {I.CORPUS}\n{S.operator_hits(name)}" for key, name in _KEYS.items()},
    "detect_person": _with_terms_sql("PERSON"),
    "detect_location": _with_terms_sql("LOCATION"),
    "detect_spaced_digits": f"WITH {I.CORPUS}\n" + " UNION ALL ".join(
        f"SELECT session_id, turn, {S.q(n)} AS operator, value FROM ({S.spaced_hits(n)})"
        for n in S.SPACED
    ),
    "detect_priority": f"WITH {I.CORPUS},\n{S.found()}\nSELECT session_id, value, operator FROM found",
    "allow_list": (
        f"WITH {I.CORPUS},\n{TERMS},\n{GRAMS},\nsuspects AS ("
        + " UNION ".join(S.operator_hits(n) for n in ("PERSON", "LOCATION", "DEFAULT"))
        + " UNION SELECT session_id, -1, value FROM matched WHERE operator = 'LOCATION')\n"
        f"SELECT DISTINCT session_id, turn, value FROM suspects WHERE NOT {S.allowed('value')} "
        f"AND lower(value) NOT IN {_REGION}"
    ),
    "detect_all": (
        f"WITH {I.CORPUS},\n{TERMS},\n{GRAMS},\nruled AS ({S.candidates()}),\n"
        "cands AS (SELECT * FROM ruled UNION ALL SELECT session_id, value, "
        f"CASE operator WHEN 'PERSON' THEN {S.PRIORITY['PERSON']} ELSE {S.PRIORITY['LOCATION']} END "
        f"FROM matched WHERE NOT {S.allowed('value')})\n{S.settled('cands')}"
    ),
    "act_replace": _names(*_REPLACING),
    "act_mask": _names("EMAIL_ADDRESS"),
    "act_mask_sep": _names(*KEEP_SEPARATORS),
}
