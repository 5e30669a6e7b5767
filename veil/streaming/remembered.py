"""Model answers on a stream: a memo that forgets by itself, and calls tried again by timers.

One state per distinct text. An answer stays in the state store for ``ttl`` and is then
removed by the store, so nothing is scanned to look it up or to expire it. Where a
call fails, the messages that wait for it are kept in the state and a timer is set, each time
twice as far ahead, so they are tried again whether or not new messages come; after
``max_tries`` they leave without an answer. A state is written with its batch: a batch
that is repeated after a failure finds the state of the batch before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from veil.operators.model import Factory, answered_once

ANSWERED, GAVE_UP, UNASKED = "answered", "gave_up", "unasked"
OUTPUT = "message STRING, text_key STRING, response STRING, tries INT, from_memo BOOLEAN, status STRING"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Settings:
    """``ttl`` of answers, first delay of a retry, and how often a text is tried."""

    ttl: timedelta = timedelta(hours=1)
    delay: timedelta = timedelta(seconds=10)
    max_tries: int = 5

    def wait_ms(self, tries: int) -> int:
        return int(self.delay.total_seconds() * 1000) << (tries - 1)


class Remembered(StatefulProcessor):
    """Per text: its answer with a time to live, or the messages that wait for one."""

    def __init__(self, factory: Factory, prompt: str, model: str, settings: Settings):
        self.factory, self.prompt, self.model, self.settings = factory, prompt, model, settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.detector = self.factory()
        self.answer = handle.getValueState("answer", "response STRING", int(self.settings.ttl.total_seconds() * 1000))
        self.waiting = handle.getListState("waiting", "message STRING")
        self.tried = handle.getValueState("tried", "text STRING, tries INT")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if self.answer.exists():
            response = self.answer.get()[0]
            for part in rows:
                yield self._out(key, part["message"], response, 0, True)
            return
        if self.tried.exists():  # a timer is set already
            for part in rows:
                self.waiting.appendList([(m,) for m in part["message"]])
            return
        yield from self._try(key, rows, 1, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        text, tries = self.tried.get()
        held = [m[0] for m in self.waiting.get()]
        yield from self._try(key, iter([pd.DataFrame({"message": held, "text": text})]), tries + 1, timerValues)

    def _try(self, key: Any, rows: Iterator[pd.DataFrame], tries: int, timers: Any) -> Iterator[pd.DataFrame]:
        first = next(rows)
        response = answered_once(self.detector, first["text"].iloc[0], self.prompt, self.model)
        again = response is None and tries < self.settings.max_tries
        if response is not None:
            self.answer.update((response,))
        if again:
            if tries == 1:
                self.waiting.put([(m,) for m in first["message"]])
                for part in rows:
                    self.waiting.appendList([(m,) for m in part["message"]])
            self.tried.update((first["text"].iloc[0], tries))
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.settings.wait_ms(tries))
            return
        self.tried.clear()
        self.waiting.clear()
        yield self._out(key, first["message"], response, tries, False)
        for part in rows:
            yield self._out(key, part["message"], response, tries, False)

    def _out(self, key: Any, messages: pd.Series, response: str | None, tries: int, memo: bool) -> pd.DataFrame:
        return pd.DataFrame({
            "message": list(messages), "text_key": key[0], "response": response, "tries": tries, "from_memo": memo,
            "status": GAVE_UP if response is None else ANSWERED,
        }).astype({"tries": "int32", "response": "object"})

    def close(self) -> None:
        pass


def text_key(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def remembered_answers(
    messages: DataFrame, factory: Factory, prompt: str, model: str, settings: Settings = Settings(),
) -> DataFrame:
    """Answers to a stream of ``message`` (kept as it is) and ``text``.

    Result: ``message``, ``text_key``, ``response``, ``tries`` (0 from the memo), ``from_memo`` and
    ``status``; one row per message, when its text has been answered or given up. A text
    is asked once as long as its answer lives. Rows without a text come back at once, unasked.
    The session needs the RocksDB state store; see :func:`use_state_store`. Timers go off
    in batches without new rows, so the stream runs until it is stopped: use a trigger
    with an interval, as the one that takes what is there never ends.
    """
    keyed = messages.where("text IS NOT NULL").select("message", "text", F.sha2("text", 256).alias("text_key"))
    asked = keyed.groupBy("text_key").transformWithStateInPandas(
        statefulProcessor=Remembered(factory, prompt, model, settings), outputStructType=OUTPUT,
        outputMode="Append", timeMode="ProcessingTime")
    return asked.unionAll(messages.where("text IS NULL").selectExpr(
        "message", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)", "0", "false", f"'{UNASKED}'"))


def use_state_store(spark: SparkSession) -> None:
    """State with a time to live and timers needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
