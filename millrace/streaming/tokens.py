"""Messages that arrive in pieces, put back together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pieces(messages: DataFrame, keys: list[str], text: str, size: int) -> DataFrame:
    """Each message cut into pieces of ``size`` characters: (keys, seq, chunk)."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size))
    cut = messages.select(*keys, F.col(text).alias("_whole"), F.posexplode(starts).alias("seq", "_start"))
    return cut.select(*keys, "seq", F.substring("_whole", F.col("_start"), F.lit(size)).alias("chunk"))


def _text():
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "chunk"))), lambda p: p["chunk"]), "")


def joined(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """The pieces of each message in arrival order. One group is one message."""
    return chunks.groupBy(*keys).agg(_text().alias("text"))


def joined_stream(chunks: DataFrame, keys: list[str], arrived: str, silence: str = "30 seconds") -> DataFrame:
    """The same for a stream of pieces: a message is complete once no piece came for ``silence``.

    The session's end is also the watermark's delay, so finished messages leave the state.
    """
    alive = chunks.withWatermark(arrived, silence)
    return alive.groupBy(*keys, F.session_window(arrived, silence)).agg(_text().alias("text")).select(*keys, "text")
