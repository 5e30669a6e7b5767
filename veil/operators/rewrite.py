"""Applying replacement pairs to the texts of a session.

A text takes the pairs of its session whose value occurs in it, longest value
first, ties by value, each as a literal replacement of every occurrence.

*Row form*: a log and its pairs share a row; the log is rewritten by array
functions. *Long form* (:func:`mask_turns`): pairs found in any turn apply to
every turn of the session, so pairs and turns meet in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.jsontext import is_json, let, read_parts, rewritten_parts, spelled_out, spelled_parts
from veil.functions.pin import pinned
from veil.operators.pairs import in_order
from veil.schema import KIND_CHAT, KIND_INTERACTION
from veil.sources.logs import SHAPES
from veil.sources.tables import stored


def apply_pairs(text: Column, pairs: Column) -> Column:
    """Replace every pair whose value occurs in ``text``, in the order given."""
    return _replace_all(text, F.filter(pairs, lambda p: F.contains(text, p["value"])))


def _replace_all(text: Column, pairs: Column) -> Column:
    return F.aggregate(
        pairs, text, lambda acc, p: F.replace(acc, p["value"], p["replacement"])
    )


def mask_arguments(text: Column, pairs: Column) -> Column:
    """Rewrite arguments, which are JSON text: values are looked for in what its strings say.

    What is no JSON is rewritten as plain text.
    """
    def changed(parts: Column) -> Column:
        # Most pairs of a session occur in no string of these arguments.
        here = let(spelled_parts(text, parts), lambda said: F.filter(pairs, lambda p: F.contains(said, p["value"])))
        return let(here, lambda present: F.when(F.size(present) == 0, text).otherwise(
            rewritten_parts(parts, lambda t: apply_pairs(t, present))))

    return F.when(is_json(text), let(read_parts(text), changed)).otherwise(apply_pairs(text, pairs))


def mask_tool_calls(calls: Column, pairs: Column) -> Column:
    """Rewrite the arguments of tool calls; names and ids stay."""
    return F.transform(calls, lambda c: c.withField(
        "function.arguments", mask_arguments(c["function"]["arguments"], pairs)
    ))


def arguments_valid(calls: Column) -> Column:
    """Whether the arguments of all calls are still JSON after the rewriting."""
    return F.forall(calls, lambda c: c["function"]["arguments"].isNull()
                    | F.try_parse_json(c["function"]["arguments"]).isNotNull())


def mask_message(message: Column, pairs: Column, tool_calls: bool = True) -> Column:
    """Rewrite the content of a chat message and, if asked, its tool calls."""
    out = message.withField("content", apply_pairs(message["content"], pairs))
    if tool_calls:
        out = out.withField("tool_calls", mask_tool_calls(message["tool_calls"], pairs))
    return out


def mask_interaction(entry: Column, pairs: Column, deep: bool = False) -> Column:
    """Rewrite history and answer of a chat interaction.

    Tool calls inside the history are rewritten only if ``deep`` is set.
    """
    inner = entry["chat_gpt"]
    history = F.transform(
        inner["request"]["chat_history"], lambda m: mask_message(m, pairs, tool_calls=deep)
    )
    answer = inner["response"]["message"]
    answer = F.when(answer.isNotNull(), mask_message(answer, pairs))
    return entry.withField("chat_gpt.request.chat_history", history).withField(
        "chat_gpt.response.message", answer
    )


def mask_entry(entry: Column, pairs: Column, deep: bool = False) -> Column:
    """Rewrite one typed entry; kinds without text pass through."""
    masked = {
        KIND_CHAT: mask_message(entry[KIND_CHAT], pairs),
        KIND_INTERACTION: mask_interaction(entry[KIND_INTERACTION], pairs, deep),
    }
    fields = [
        F.when(entry["kind"] == kind, masked[kind]).alias(kind)
        if kind in masked else entry[kind].alias(kind)
        for kind in SHAPES
    ]
    return F.struct(entry["kind"].alias("kind"), *fields)


def mask_log(log: Column, pairs: Column, deep: bool = False) -> Column:
    """Rewrite a typed log in entry order; without pairs it stays as it is."""
    masked = F.transform(log, lambda e: mask_entry(e, pairs, deep))
    return F.when(F.size(pairs) > 0, masked).otherwise(log)


def log_texts(log: Column, scope: str = "all") -> Column:
    """Texts of a log that detection reads, as one string with a line per text.

    ``all`` takes the content of every chat message and interaction and the
    tool-call arguments, ``messages`` the content of chat messages only.
    Arguments are JSON text, so their strings are read as what they say.
    """
    chat, chat_gpt = KIND_CHAT, KIND_INTERACTION

    def said(e: Column) -> Column:
        return F.array(e[chat]["content"])

    def arguments(message: Column) -> Column:
        return F.transform(message["tool_calls"], lambda c: let(
            c["function"]["arguments"], lambda a: F.when(is_json(a), spelled_out(a)).otherwise(a)))

    def everything(e: Column) -> Column:
        inner = e[chat_gpt]["chat_gpt"]
        none = F.array().cast("array<string>")
        return F.concat(
            said(e),
            F.coalesce(arguments(e[chat]), none),
            F.coalesce(
                F.transform(inner["request"]["chat_history"], lambda m: m["content"]), none
            ),
            F.array(inner["response"]["message"]["content"]),
            F.coalesce(arguments(inner["response"]["message"]), none),
        )

    pick = everything if scope == "all" else said
    # ``array_join`` leaves out NULL elements.
    return F.array_join(F.flatten(F.transform(log, pick)), "\n")


# Blocks of a session for turns without a number.
BLOCKS_WITHOUT_NUMBER = 4096
# Sessions with more pairs than this never have them collected into one row.
MAX_PAIRS_IN_ROW = 1000
# Turns of a session that share one row of pairs in the join.
BLOCK = 64
# Longest piece of text used to look up values.
PIECE = 8
# Spread of a join key that may be hot.
SALTS = 32


def _block(turn: str = "turn") -> Column:
    # Turns without a number go to blocks of their own by the hash of their text.
    unnumbered = -1 - F.pmod(F.xxhash64("text"), F.lit(BLOCKS_WITHOUT_NUMBER))
    return F.coalesce(F.floor(F.col(turn) / BLOCK).cast("bigint"), unnumbered).alias("block")


def _pair_array() -> Column:
    return in_order(F.collect_list(F.struct("value", "replacement"))).alias("pairs")


def mask_turns(
    turns: DataFrame, pairs: DataFrame, max_pairs: int = MAX_PAIRS_IN_ROW
) -> DataFrame:
    """Long form: rewrite every turn with the pairs of its session.

    ``pairs`` has one row per ``(session_id, value)``. Result: the columns of
    ``turns`` with ``masked_text`` and ``n_pairs`` (pairs that occur in it).
    """
    return with_present_pairs(turns, pairs, max_pairs).select(
        *turns.columns,
        _replace_all(F.col("text"), F.col("pairs")).alias("masked_text"),
        F.size("pairs").cast("bigint").alias("n_pairs"),
    )


def with_present_pairs(
    turns: DataFrame, pairs: DataFrame, max_pairs: int = MAX_PAIRS_IN_ROW
) -> DataFrame:
    """Add to every turn the ``pairs`` of its session that occur in its ``text``, in order.

    Turns and pairs meet on ``(session_id, block)``, a block being
    :data:`BLOCK` consecutive turns, so the texts are shuffled once and a session
    that holds a third of all turns spreads over as many keys as it has blocks.
    The row of pairs on the other side is the whole list of the session where
    that is short (``max_pairs``). For a session with more, it is only the pairs
    that can occur in the block, see :func:`pairs_by_piece`. Both give the same
    result, because a text takes only the pairs that occur in it.

    The pairs are written to the shared folder first: finding them is a pass
    over all texts, several branches need them, and whether there is a session
    with many pairs at all is then cheap to see.
    """
    usable = stored(
        pairs.where((F.col("value") != "") & (F.col("value") != F.col("replacement")))
        .select("session_id", "value", "replacement"),
        "pairs",
    )
    crowded = (
        usable.groupBy("session_id").agg(F.count("*").alias("n"))
        .where(F.col("n") > max_pairs).select("session_id")
    )
    blocks = turns.select("session_id", _block()).distinct()
    if crowded.isEmpty():
        by_block = blocks.join(usable.groupBy("session_id").agg(_pair_array()), "session_id")
    else:
        by_block = _pairs_of_blocks(turns, blocks, usable, crowded)
    none = F.array().cast("array<struct<value string, replacement string>>")
    joined = turns.withColumn("block", _block()).join(by_block, ["session_id", "block"], "left")
    present = F.filter(F.coalesce("pairs", none), lambda p: F.contains(F.col("text"), p["value"]))
    return pinned(joined, pairs=present).select(*turns.columns, "pairs")


def _pairs_of_blocks(
    turns: DataFrame, blocks: DataFrame, usable: DataFrame, crowded: DataFrame
) -> DataFrame:
    """Pairs per block where some sessions have too many pairs to collect."""
    salted = usable.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int"))
    all_salts = crowded.select(
        "session_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    few = salted.join(all_salts, ["session_id", "salt"], "left_anti")
    many = salted.join(all_salts, ["session_id", "salt"], "left_semi").drop("salt")
    return blocks.join(
        few.groupBy("session_id").agg(_pair_array()), "session_id"
    ).unionByName(pairs_by_piece(turns, blocks, many))


def _pieces(text: Column, length: Column) -> Column:
    """Distinct substrings of ``length`` characters."""
    n = F.char_length(text) - length + 1
    return F.array_distinct(F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.substr(text, i, length),
    ))


def pairs_by_piece(turns: DataFrame, blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs that can occur in each block, for sessions with very many pairs.

    Result: ``(session_id, block, pairs)``; its size is bounded by the text of
    the block, not by the pairs of the session.

    Every value is looked up by one piece of it: the value itself when it is
    short, else the piece of :data:`PIECE` characters that fewest values of its
    session share. A text holds a value only if it holds that piece, so joining
    the pieces of the texts with these anchors misses nothing. Keys are
    ``(session_id, piece)``: the hottest session spreads over as many keys as
    its texts have pieces.
    """
    length = F.least(F.char_length("value"), F.lit(PIECE))
    spelled = pairs.select(
        "session_id", "value", "replacement",
        F.explode(_pieces(F.col("value"), length)).alias("piece"),
    )
    shared = spelled.groupBy("session_id", "piece").agg(F.count("*").alias("sharers"))
    anchors = (
        spelled.join(shared, ["session_id", "piece"])
        .groupBy("session_id", "value", "replacement")
        .agg(F.min_by("piece", F.struct("sharers", "piece")).alias("piece"))
    )
    # The lengths that occur in a session: at most PIECE numbers.
    lengths = pairs.groupBy("session_id").agg(F.collect_set(length).alias("lengths"))
    wanted = blocks.join(lengths, "session_id")
    seen = (
        turns.select("session_id", _block(), "text")
        .join(wanted, ["session_id", "block"])
        .select("session_id", "block", "text", F.explode("lengths").alias("length"))
        .select("session_id", "block", F.explode(_pieces(F.col("text"), F.col("length"))).alias("piece"))
        .distinct()
    )
    return (
        seen.join(anchors, ["session_id", "piece"])
        .select("session_id", "block", "value", "replacement").distinct()
        .groupBy("session_id", "block").agg(_pair_array())
    )
