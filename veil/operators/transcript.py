"""Plain-text transcripts of sessions, with duplicate lines removed.

Row form (a log in one row): array functions, no shuffle. Long form (one row
per turn): duplicates are removed by an aggregation on ``(session_id, line)``,
which has no hot key, and the text is assembled in parts of bounded length, so
a session with any number of turns never lands in one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.text import between_tags, flatten_newlines
from veil.schema import KIND_CHAT

USER, ASSISTANT = "user", "assistant"
USER_TAG, ASSISTANT_TAG = "user_input", "assistant_response"


def role_label(role: Column) -> Column:
    """``user`` stays; system, tool and function speak as the assistant."""
    return F.when(role == USER, F.lit(USER)).otherwise(F.lit(ASSISTANT))


def spoken(role: Column, flat: Column) -> Column:
    """What a turn says, given its text without newlines."""
    return F.when(role == USER, between_tags(flat, USER_TAG, flat)).otherwise(
        between_tags(flat, ASSISTANT_TAG, F.btrim(flat, F.lit('"')))
    )


def line(role: Column, flat: Column) -> Column:
    return F.concat(role_label(role), F.lit(": "), spoken(role, flat), F.lit("\n"))


def log_lines(log: Column) -> Column:
    """Distinct lines of a typed log in order of first appearance."""
    turns = F.transform(
        F.filter(log, lambda e: e["kind"] == KIND_CHAT),
        lambda e: F.struct(
            e[KIND_CHAT]["role"].alias("role"),
            flatten_newlines(e[KIND_CHAT]["content"]).alias("flat"),
        ),
    )
    return F.array_distinct(F.transform(turns, lambda t: line(t["role"], t["flat"])))


def log_transcript(log: Column) -> Column:
    return F.array_join(log_lines(log), "")


def turn_lines(turns: DataFrame) -> DataFrame:
    """Long form: the line of every turn, duplicates included."""
    return turns.withColumn("flat", flatten_newlines(F.col("text"))).select(
        "session_id", "turn", line(F.col("role"), F.col("flat")).alias("line")
    )


def distinct_lines(lines: DataFrame) -> DataFrame:
    """First appearance of each line of a session."""
    return lines.groupBy("session_id", "line").agg(F.min("turn").alias("turn"))


def transcript_parts(turns: DataFrame, turns_per_part: int = 256) -> DataFrame:
    """Transcript of every session, in parts of at most ``turns_per_part`` turns.

    Parts are cut by turn number, which must be unique within a session, so a
    session of any length is spread over as many tasks as it has parts. For
    readers that take a transcript piece by piece.
    """
    lines = distinct_lines(turn_lines(turns))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "line")))
    return (
        lines.withColumn("part", F.floor(F.col("turn") / turns_per_part).cast("bigint"))
        .groupBy("session_id", "part")
        .agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "").alias("transcript"))
    )


def transcripts(turns: DataFrame) -> DataFrame:
    """The whole transcript of every session, one row each.

    It is put together from parts, so what meets in one task is a row per part,
    and the text itself must fit a row.
    """
    parts = F.sort_array(F.collect_list(F.struct("part", "transcript")))
    return transcript_parts(turns).groupBy("session_id").agg(
        F.array_join(F.transform(parts, lambda x: x["transcript"]), "").alias("transcript"))
