"""The operator table that a prompt text declares.

A prompt names its operators in a block ``OPERATORS = {…}`` followed by a blank
line. The block is cut out, freed of trailing commas and read as a map. Of several
braces before a blank line the last one ends the block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.functions.jsontext import let
from veil.schema import OPERATOR_ROW, OPERATORS, Operator

# How the block begins (fixed value of the format).
OPENING = r"OPERATORS\s*=\s*\{"
# White space is what can make a line blank.
BLANKS = " \t\r\f\n"
# A string, a sign, or a run of anything else. A quote that nothing closes stays a token,
# so that the text stays unreadable.
TOKEN = r"""("[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\]:,"]|[^\s{}\[\]:,"]+)"""

_ACTION = "STRUCT<type STRING, new_value STRING, masking_char STRING, chars_to_mask INT, from_end BOOLEAN>"


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompt files, one row per file; a missing path raises."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("prompt"))


def write_prompts(prompts: DataFrame, path: str, keys: list[str]) -> None:
    """Write prompts with their keys, many to a file, as :func:`read_keyed_prompts` takes them.

    Prompts may span lines, so a file holds one JSON object per line.
    """
    prompts.select(*keys, "prompt").write.json(path)


def read_keyed_prompts(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """Prompts written by :func:`write_prompts`; ``keys`` declares the key columns."""
    return spark.read.schema(f"{keys}, prompt STRING").json(path)


def operators_block(prompt: Column) -> Column:
    """The block of a prompt with the blank lines after it, NULL when there is none."""
    opened = F.regexp_instr(prompt, F.lit(OPENING))
    body = F.substring(prompt, opened, F.length(prompt))
    # What follows each closing brace; the first piece is what comes before any.
    pieces = F.split(F.substring(body, F.instr(body, "{"), F.length(body)), r"\}")
    return F.when(opened > 0, let(pieces, _closed))


def _closed(pieces: Column) -> Column:
    """The pieces up to the last brace before a blank line, joined again."""
    gaps = F.transform(pieces, lambda p: F.substring(p, F.lit(1), F.length(p) - F.length(F.ltrim(p, F.lit(BLANKS)))))
    # Place, white space and line breaks after each brace that a blank line follows.
    ends = F.filter(
        F.transform(gaps, lambda g, k: F.struct(k.alias("k"), g.alias("gap"), (F.size(F.split(g, "\n")) - 1).alias("lines"))),
        lambda e: (e["k"] > 0) & (e["lines"] > 1))

    def cut(last: Column) -> Column:
        kept = F.concat(F.array_join(F.slice(pieces, 1, last["k"]), "}"), F.lit("}"))
        # The blank lines end with their last line break.
        after = F.concat(F.call_function("substring_index", last["gap"], F.lit("\n"), last["lines"]), F.lit("\n"))
        return F.when(last.isNotNull(), F.concat(kept, after))

    return let(F.try_element_at(ends, F.lit(-1)), cut)


def without_trailing_commas(text: Column) -> Column:
    """JSON text, token by token, without commas that a closing brace or nothing follows."""
    def needed(tokens: Column) -> Column:
        return F.filter(tokens, lambda t, k: (t != ",") | (F.coalesce(F.get(tokens, k + 1), F.lit("}")) != "}"))
    return F.array_join(let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), needed), "")


def operators_map(prompt: Column) -> Column:
    """Operator name -> action; NULL without a readable block."""
    return F.from_json(without_trailing_commas(operators_block(prompt)), f"MAP<STRING,{_ACTION}>")


def valid_tags(prompt: Column) -> Column:
    """Distinct replacement tags; NULL (accept everything) when there are none."""
    tags = F.array_distinct(F.filter(
        F.transform(F.map_values(operators_map(prompt)), lambda a: a["new_value"]),
        lambda t: t.isNotNull(),
    ))
    return let(tags, lambda t: F.when(F.size(t) > 0, t))


def operators_table(prompts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per prompt and operator, in the columns of the operator table."""
    rows = prompts.select(
        *keys, F.explode(F.map_entries(operators_map(F.col("prompt")))).alias("e")
    )
    return rows.select(*keys, F.col("e.key").alias("name"), "e.value.*")


def default_table(spark: SparkSession, operators: tuple[Operator, ...] = OPERATORS) -> DataFrame:
    """The built-in operators as a DataFrame."""
    return spark.createDataFrame([op.row() for op in operators], OPERATOR_ROW)


def load_operators(spark: SparkSession, path: str) -> tuple[Operator, ...]:
    """Operators declared by a prompt file, for use as configuration.

    The table of one prompt is configuration of a job, read once when the job
    is put together. Priorities follow the built-in order; names that are not
    built in come before ``DEFAULT``.
    """
    known = {op.name: op.priority for op in OPERATORS}
    rows = operators_table(read_prompts(spark, path), []).collect()
    return tuple(sorted(
        (Operator(r["name"], r["type"], r["new_value"], r["masking_char"], r["chars_to_mask"],
                  r["from_end"], known.get(r["name"], known["DEFAULT"] - 1)) for r in rows),
        key=lambda op: (op.priority, op.name),
    ))
