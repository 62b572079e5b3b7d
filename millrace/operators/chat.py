"""Conversations as ordered message tables: history, limits, endings.

A conversation may hold any share of all messages, so nothing here sorts or collects a whole one:
running values are taken block by block, and short looks back are joins on (conversation, place).
Messages are (conv_id, turn, role, text); turns count up within a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.operators.ordering import blocked_row_number, blocked_running, range_running
from millrace.sources.staging import stage

TURNS_PER_BLOCK = 4096


def _cut(messages: DataFrame) -> DataFrame:
    return messages.withColumn("_block", F.floor(F.col("turn") / TURNS_PER_BLOCK))


def prior_turns(messages: DataFrame) -> DataFrame:
    """Each message with the extent of the history sent along with it.

    The history of a message is all earlier messages of its conversation, oldest first, and it is
    sent again with every turn. Writing it out would grow with the square of a conversation, so it
    is kept as (prior_messages, prior_chars, prior_user) over the message table itself:
    ``history_of`` gives the messages behind such a reference.
    """
    chars = F.length("text").cast("bigint")
    is_user = (F.col("role") == "user").cast("bigint")
    running = blocked_running(_cut(messages), ["conv_id"], [F.col("turn")], ["_block"], {
        "_n": ("sum", F.lit(1).cast("bigint")), "_c": ("sum", chars), "_u": ("sum", is_user),
    })
    return running.select(
        *messages.columns, (F.col("_n") - 1).alias("prior_messages"), (F.col("_c") - chars).alias("prior_chars"),
        (F.col("_u") - is_user).alias("prior_user"),
    )


def history_of(messages: DataFrame, asks: DataFrame) -> DataFrame:
    """(conv_id, ask_turn, turn, role, text): the messages before each ask, as rows.

    With one ask per conversation the result is no larger than the message table.
    """
    wanted = asks.select("conv_id", F.col("turn").alias("ask_turn"))
    return messages.join(wanted, "conv_id").filter(F.col("turn") < F.col("ask_turn")).select(
        "conv_id", "ask_turn", "turn", "role", "text"
    )


# Messages in a block of a conversation.
BLOCK = 256


def placed(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Messages with their place in the conversation (from 0) and its block, on disk.

    Blocks are what histories share: a message's history is all blocks before its own, whole, and the messages before it in
    its own. Messages of one turn are in the order of a hash of them; a conversation without an id is one like any other.
    """
    tie = F.xxhash64("role", "text")
    rows = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    numbered = range_running(rows, ["conv_id"], [F.col("turn"), tie], {"_n": ("sum", F.lit(1).cast("bigint"))})
    place = F.col("_n") - 1
    return stage(numbered.select(*rows.columns, place.alias("place"), F.floor(place / block).alias("block")), "placed")


def histories(numbered: DataFrame, asks: Column) -> DataFrame:
    """(conv_id, ask_turn, ask_place, prefix_blocks): the histories of the messages for which ``asks`` holds, one row each.

    A history is the first ``prefix_blocks`` blocks of its conversation, which all later ones share, and the messages of the next
    block that are before ``ask_place``. ``expanded`` writes them out.
    """
    return numbered.filter(asks).select("conv_id", F.col("turn").alias("ask_turn"), F.col("place").alias("ask_place"),
                                        F.col("block").alias("prefix_blocks"))


def expanded(numbered: DataFrame, referred: DataFrame) -> DataFrame:
    """(conv_id, ask_turn, place, turn, role, text): the messages of histories, as rows.

    Histories meet messages by (conversation, block), so that a long conversation is spread over its blocks.
    """
    wanted = referred.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), "prefix_blocks"))).withColumnRenamed("conv_id", "_conv")
    both = numbered.join(wanted, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    return both.filter(F.col("place") < F.col("ask_place")).select("conv_id", "ask_turn", "place", "turn", "role", "text")


def last_asks(messages: DataFrame) -> DataFrame:
    """The latest user message of each conversation: (conv_id, turn, text)."""
    last = messages.filter("role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return messages.join(last, ["conv_id", "turn"], "left_semi").select("conv_id", "turn", "text")


def first_turns(messages: DataFrame, n: int) -> DataFrame:
    """At most the first n messages of each conversation; tasks drop the rest before the shuffle."""
    order = W.partitionBy("conv_id").orderBy("turn")
    return messages.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n).drop("_rn")


def exchanges(messages: DataFrame, max_turns: int) -> DataFrame:
    """Messages up to the end of exchange ``max_turns``; each user message opens an exchange."""
    running = blocked_running(
        _cut(messages), ["conv_id"], [F.col("turn")], ["_block"], {"_x": ("sum", (F.col("role") == "user").cast("bigint"))}
    )
    return running.filter(F.col("_x") <= max_turns).select(*messages.columns)


def last_messages(messages: DataFrame, n: int) -> DataFrame:
    """(conv_id, turn, looked_at, last_text): what a look at the last n messages before a turn sees.

    Places are cut into cells; the last n messages of a cell are also laid into the next one, so a
    look back never leaves its cell and only n in every block of messages travel twice.
    """
    placed = blocked_row_number(_cut(messages), ["conv_id"], [F.col("turn")], ["_block"], "_at")
    size = max(TURNS_PER_BLOCK, n)
    cell = F.floor(F.col("_at") / size)
    cells = F.when(F.col("_at") % size >= size - n, F.array(cell, cell + 1)).otherwise(F.array(cell))
    laid = placed.select("conv_id", "turn", "_at", "role", "text", F.explode(cells).alias("_cell"))
    back = W.partitionBy("conv_id", "_cell").orderBy("_at").rowsBetween(-n, -1)
    line = F.concat("role", F.lit(": "), "text")
    seen = laid.withColumn("_seen", F.collect_list(line).over(back)).filter(F.col("_cell") == cell)
    return seen.select(
        "conv_id", "turn", F.size("_seen").cast("bigint").alias("looked_at"), F.array_join("_seen", "\n").alias("last_text")
    )


def until_terminate(
    messages: DataFrame, automatic: Column, marker: str = "TERMINATE", most_in_a_row: int = 3
) -> DataFrame:
    """Messages up to the first one holding the marker (included), or up to the automatic reply
    that would be one too many in a row (not included)."""
    marked = F.coalesce(F.contains("text", F.lit(marker)), F.lit(False))
    # Only flags travel through the running passes; the texts are read again at the end.
    flags = _cut(messages.select(
        "conv_id", "turn", F.coalesce(automatic, F.lit(False)).alias("_auto"), marked.alias("_marked")
    ))
    counted = stage(blocked_running(
        flags, ["conv_id"], [F.col("turn")], ["_block"], {"_n": ("sum", F.col("_auto").cast("bigint"))}
    ), "counted")
    broken = blocked_running(counted, ["conv_id"], [F.col("turn")], ["_block"], {
        "_broken": ("max", F.when(~F.col("_auto"), F.col("_n"))),
    })
    over = F.col("_auto") & (F.col("_n") - F.coalesce("_broken", F.lit(0)) > most_in_a_row)
    ends = broken.groupBy("conv_id").agg(
        F.min(F.when(over, F.col("turn"))).alias("_over"), F.min(F.when(F.col("_marked"), F.col("turn"))).alias("_end")
    ).filter("_over is not null or _end is not null")
    within = (F.col("_over").isNull() | (F.col("turn") < F.col("_over"))) & (
        F.col("_end").isNull() | (F.col("turn") <= F.col("_end"))
    )
    return messages.join(ends, "conv_id", "left").filter(within).select(*messages.columns)
