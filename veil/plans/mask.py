"""The complete masking job for a batch of message envelopes.

A message carries its whole session log, so everything from parsing to the
rewritten log happens inside the row: reading, detection, resolution and
rewriting are one stage without a shuffle. The model detector adds what it
must: one exchange to make the texts distinct and one to bring answers back.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.pin import pinned
from veil.operators import model as model_ops
from veil.operators.detect import is_allowed, resolve, with_found
from veil.operators.gazetteer import match_terms
from veil.operators.pairs import FOUND, NONE_FOUND, in_order, usable, with_pairs
from veil.operators.rewrite import log_texts, mask_log
from veil.operators.transcript import log_transcript
from veil.plans.outcome import with_disposition
from veil.schema import OPERATORS, Operator
from veil.sources.envelopes import session_name, with_defaults, with_delivery_key
from veil.sources.logs import log_json, with_log

RESULT = (
    "seq", "published", "session_name", "disposition", "saved", "retry", "pair_status",
    "pairs", "log", "headers", "subject", "payload",
)


def parsed(envelopes: DataFrame) -> DataFrame:
    """Envelopes with defaults, ``session_name`` and the typed log in ``entries``."""
    return with_log(
        with_defaults(envelopes).withColumn("session_name", session_name()), out="entries"
    )


def finish(rows: DataFrame, answered: Column, on_unparsed: str, deep: bool = False) -> DataFrame:
    """Disposition and rewritten log of parsed rows that have ``pairs``."""
    good = None
    if on_unparsed == "quarantine":
        good = F.col("pair_status").isin(FOUND, NONE_FOUND)
    elif on_unparsed != "passthrough":
        raise ValueError("on_unparsed must be 'quarantine' or 'passthrough'")
    done = with_disposition(
        rows, F.col("session_name"), F.col("entries").isNotNull(), answered, good
    )
    masked = log_json(mask_log(F.col("entries"), F.col("pairs"), deep))
    return done.withColumn("log", F.when(F.col("saved"), masked)).select(*RESULT)


def with_lists(
    rows: DataFrame, operators: tuple[Operator, ...], terms: DataFrame | None, allow: DataFrame | None
) -> DataFrame:
    """Add listed terms to ``_found``, and take allowed values out of it.

    ``terms`` has (term, operator), ``allow`` has value, which stays in any case.
    Both may be large: they meet the words and values of the messages in equi-joins, and
    come back to their messages by the delivery key, one row per message.
    """
    rows = with_delivery_key(rows)
    if terms is not None:
        ranks = F.create_map(*[F.lit(x) for op in operators for x in (op.name, op.priority)])
        texts = rows.select(F.col("delivery_key").alias("session_id"), F.col("_text").alias("text"))
        hits = match_terms(texts, terms).select(
            F.col("session_id").alias("delivery_key"),
            F.struct("value", ranks[F.col("operator")].alias("priority"), "operator").alias("hit"),
        ).where(F.col("hit.priority").isNotNull() & ~is_allowed("hit.value"))
        listed = hits.groupBy("delivery_key").agg(F.collect_set("hit").alias("_listed"))
        by_rule = F.transform(F.coalesce("_found", F.array()), lambda p: F.struct(
            p["value"].alias("value"), ranks[p["operator"]].alias("priority"), p["operator"].alias("operator")))
        both = rows.join(listed, "delivery_key", "left").withColumn("_hits", F.sort_array(F.concat(
            by_rule, F.coalesce("_listed", F.array().cast("array<struct<value string, priority int, operator string>>")))))
        rows = pinned(both, _merged=resolve("_hits", operators)).drop("_found", "_listed", "_hits").withColumnRenamed("_merged", "_found")
    if allow is not None:
        words = allow.select(F.lower("value").alias("word")).distinct()
        values = rows.select("delivery_key", F.explode("_found.value").alias("value")).withColumn("word", F.lower("value"))
        stays = values.join(words, "word", "left_semi").groupBy("delivery_key").agg(F.collect_set("value").alias("_stays"))
        rows = rows.join(stays, "delivery_key", "left").withColumn("_found", F.filter(
            "_found", lambda p: ~F.coalesce(F.array_contains("_stays", p["value"]), F.lit(False)))).drop("_stays")
    return rows.drop("delivery_key")


def mask_sessions(
    envelopes: DataFrame, operators: Iterable[Operator] = OPERATORS, scope: str = "all",
    deep: bool = False, terms: DataFrame | None = None, allow: DataFrame | None = None,
) -> DataFrame:
    """Mask a batch with the rule detector. One row per message, no shuffle without lists.

    ``scope`` says what detection reads: ``all`` texts of the log, the chat
    ``messages``, or the ``transcript`` that a model would see. Replacements
    apply to every text of the log in any case. ``terms`` (term, operator) are
    found as well, words and values of ``allow`` (value) stay; see :func:`with_lists`.
    """
    operators = tuple(operators)
    rows = parsed(envelopes)
    if scope == "transcript":
        text = log_transcript(F.col("entries"))
    else:
        text = log_texts(F.col("entries"), scope)
    found = with_found(rows.withColumn("_text", text), "_text", "_found", operators)
    if terms is not None or allow is not None:
        found = with_lists(found, operators, terms, allow)
    ready = found.withColumn(
        "pairs", in_order(usable(F.coalesce("_found", F.array().cast(
            "array<struct<value string, replacement string, operator string>>"))))
    ).withColumn("pair_status", F.when(F.size("pairs") > 0, FOUND).otherwise(NONE_FOUND))
    return finish(ready, F.lit(True), "quarantine", deep)


def mask_with_responses(
    envelopes: DataFrame, responses: DataFrame, tags: Column | None = None,
    on_unparsed: str = "quarantine", deep: bool = False,
) -> DataFrame:
    """Mask a batch with recorded responses ``(session_name, response)``.

    ``session_name`` must be unique in ``responses``. A message without a
    response counts as a failed model call.
    """
    rows = parsed(envelopes).join(responses, "session_name", "left")
    return finish(
        with_pairs(rows, "response", tags), F.col("response").isNotNull(), on_unparsed, deep
    )


def with_transcripts(envelopes: DataFrame) -> DataFrame:
    """Parsed envelopes with the transcript of each log in ``text``."""
    return parsed(envelopes).withColumn("text", log_transcript(F.col("entries")))


def askable(rows: DataFrame) -> DataFrame:
    """Only parseable messages with a session name are worth a model call."""
    return rows.where(F.col("entries").isNotNull() & F.col("session_name").isNotNull())


def mask_answered(
    rows: DataFrame, found: DataFrame, tags: Column | None = None,
    on_unparsed: str = "quarantine", deep: bool = False,
) -> DataFrame:
    """Finish rows of :func:`with_transcripts` with the answers to their texts."""
    answered = with_pairs(
        model_ops.with_answers(rows, found.select("text_key", "text", "response")),
        "response", tags,
    )
    return finish(answered, F.col("response").isNotNull(), on_unparsed, deep)


def mask_with_model(
    envelopes: DataFrame, factory: model_ops.Factory, prompt: str, model: str,
    tags: Column | None = None, memo: DataFrame | None = None,
    on_unparsed: str = "quarantine", attempts: int = model_ops.ATTEMPTS, deep: bool = False,
) -> DataFrame:
    """Mask a batch with a user-supplied model, each distinct transcript asked once."""
    rows = with_transcripts(envelopes)
    found = model_ops.answers(askable(rows), factory, prompt, model, memo, attempts)
    return mask_answered(rows, found, tags, on_unparsed, deep)
