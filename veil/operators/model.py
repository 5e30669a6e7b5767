"""Detection by a model that the user supplies, and the memo of its answers.

The model sees every distinct text once. The user gives a *factory*, called
once per partition (so clients and weights are built there), that returns a
function ``(texts, prompt, model) -> answers``, one answer per text: the
response body as a string, a pair of status and body, or ``None`` for a failed call.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Answer = str | tuple[int, str] | None
Detector = Callable[[Sequence[str], str, str], Sequence[Answer]]
Factory = Callable[[], Detector]

ATTEMPTS = 3
MEMO_TTL = "1 hour"
# Texts of one call, and tasks per core of the cluster that calls are spread over.
TEXTS_PER_CALL = 16
TASKS_PER_CORE = 4
ANSWER = "text STRING, response STRING, attempts INT"
# Names of the response headers with durations in milliseconds (fixed values).
DURATION_HEADER = "x-litellm-response-duration-ms"
OVERHEAD_HEADER = "x-litellm-overhead-duration-ms"


def request_body(model: Column, prompt: Column, text: Column) -> Column:
    """Request as JSON text: system and user message, temperature 0."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.to_json(F.struct(
        model.alias("model"),
        F.array(message("system", prompt), message("user", text)).alias("messages"),
        F.lit(0).alias("temperature"),
    ))


def accepted(status: Column, body: Column) -> Column:
    """The body of a successful call as it is; NULL for a bad status or no JSON."""
    is_json = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))).isNotNull()
    return F.when(status.between(200, 299) & is_json & (F.trim(body) != ""), body)


def reported(headers: Column, name: str) -> Column:
    """A duration reported in a response header, ``"0"`` when it is absent."""
    return F.coalesce(F.try_element_at(headers, F.lit(name)), F.lit("0"))


def _body(answer: Answer) -> str | None:
    """The body of a usable answer: a good status, if there is one, and JSON."""
    if isinstance(answer, tuple):
        status, answer = answer
        if not 200 <= status <= 299:
            return None
    try:
        json.loads(answer)
    except (TypeError, ValueError):
        return None
    return answer


def _call(detector: Detector, texts: list[str], prompt: str, model: str) -> list[str | None]:
    """One call; what it raises, or a wrong number of answers, is a failure of all its texts."""
    try:
        answers = list(detector(texts, prompt, model))
    except Exception:  # noqa: BLE001 - a failed call is data, not an error
        answers = []
    return [_body(a) for a in answers] if len(answers) == len(texts) else [None] * len(texts)


def answered_once(detector: Detector, text: str, prompt: str, model: str) -> str | None:
    """The usable answer to one text, asked once; None where the call failed."""
    return _call(detector, [text], prompt, model)[0]


def ask(
    texts: DataFrame, factory: Factory, prompt: str, model: str, attempts: int = ATTEMPTS,
    texts_per_call: int = TEXTS_PER_CALL, tasks: int | None = None,
) -> DataFrame:
    """Ask the model about each row of ``texts`` (column ``text``).

    Calls are spread over ``tasks`` tasks whatever the size of the input, as
    they wait and do not compute. A failed text (``None``, an exception, a bad
    status or no JSON) is asked again at once and alone, up to ``attempts`` times
    in all, so one bad text costs its call no other answer; after that the
    response is NULL. The loop is part of the task, so it does not depend on
    Spark repeating tasks.
    """
    tasks = tasks or TASKS_PER_CORE * texts.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = factory()
        for batch in batches:
            rows = []
            for at in range(0, len(batch), texts_per_call):
                group = list(batch["text"][at : at + texts_per_call])
                for text, body in zip(group, _call(detector, group, prompt, model), strict=True):
                    attempt = 1
                    while body is None and attempt < attempts:
                        body, attempt = _call(detector, [text], prompt, model)[0], attempt + 1
                    rows.append((text, body, attempt))
            yield pd.DataFrame(rows, columns=["text", "response", "attempts"])

    # A number given with the key keeps adaptive execution from merging the tasks again.
    return texts.select("text").repartition(tasks, "text").mapInPandas(run, ANSWER)


def keyed(texts: DataFrame) -> DataFrame:
    """Add the lookup key of column ``text``."""
    return texts.withColumn("text_key", F.sha2("text", 256))


def live_memo(
    memo: DataFrame, now: Column, ttl: str = MEMO_TTL, entries: int | None = None
) -> DataFrame:
    """Memo rows that are still valid: not older than ``ttl``.

    A number of ``entries`` keeps the newest only, a top-k by time that every
    task applies to its own rows before the few survivors meet.
    """
    fresh = memo.where(F.col("responded_at") > now - F.expr(f"INTERVAL {ttl}"))
    if entries is None:
        return fresh
    return fresh.orderBy(F.desc("responded_at"), "text_key").limit(entries)


def memo_misses(texts: DataFrame, memo: DataFrame) -> DataFrame:
    """Distinct texts that have no answer yet."""
    return keyed(texts.select("text").distinct()).join(
        memo.select("text_key"), "text_key", "left_anti"
    )


def answers(
    texts: DataFrame, factory: Factory, prompt: str, model: str,
    memo: DataFrame | None = None, attempts: int = ATTEMPTS,
) -> DataFrame:
    """Answers to the distinct texts: ``(text_key, text, response, attempts)``.

    With a memo, only texts without an entry are asked; ``attempts`` is 0 for
    an answer from the memo. Append the rows with a response and attempts > 0
    to the memo afterwards; failures are not remembered.
    """
    if memo is None:
        return keyed(ask(texts.select("text").distinct(), factory, prompt, model, attempts))
    fresh = keyed(ask(memo_misses(texts, memo), factory, prompt, model, attempts))
    known = keyed(texts.select("text").distinct()).join(
        memo.select("text_key", "response"), "text_key"
    ).withColumn("attempts", F.lit(0))
    return known.unionByName(fresh)


def memo_rows(found: DataFrame, now: Column) -> DataFrame:
    """What to append to the memo after :func:`answers`."""
    return found.where(F.col("response").isNotNull() & (F.col("attempts") > 0)).select(
        "text_key", "text", "response", now.alias("responded_at")
    )


def with_answers(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Give every row (column ``text``) the answer to its text.

    Many rows may share a text: the answers are unique per key, so this is an
    N:1 join whose hot partition adaptive execution can split. Rows without a
    text go around it.
    """
    known = found.drop("text")
    met = keyed(rows.where(F.col("text").isNotNull())).join(known, "text_key", "left").drop("text_key")
    return met.unionByName(rows.where(F.col("text").isNull()), allowMissingColumns=True)
