"""Documents cut into overlapping pieces."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.sampling import words
from millrace.operators.sizing import computed_once, small_side
from millrace.sources.staging import stage

# Break points tried in this order; the empty one means single characters.
BREAKS = ["\n\n", "\n", " ", ""]


def fixed_chunks(
    docs: DataFrame, key: str, text: str, size: int = 800, stride: int = 740, keep: list[str] = ()
) -> DataFrame:
    """(key, kept columns, chunk from 0, text): windows of ``size`` characters every ``stride``.

    No Python and no shuffle; the metadata columns travel along.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(stride))
    cut = docs.select(key, *keep, F.col(text).alias("_whole"), F.posexplode(starts).alias("chunk", "_start"))
    piece = F.substring("_whole", F.col("_start") + 1, F.lit(size))
    return cut.select(key, *keep, F.col("chunk").cast("bigint").alias("chunk"), piece.alias("text"))


def _cut_at(text: str, mark: str) -> list[str]:
    """Pieces that each start with the mark they were cut at; nothing is lost."""
    if mark == "":
        return list(text)
    head, *rest = text.split(mark)
    return [p for p in [head, *[mark + r for r in rest]] if p]


def _packed(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Neighbouring pieces put together up to ``size``; a new chunk keeps up to ``overlap`` of the last."""
    held: deque[str] = deque()
    chars = 0
    for piece in pieces:
        if held and chars + len(piece) > size:
            yield "".join(held)
            while held and (chars > overlap or chars + len(piece) > size):
                chars -= len(held.popleft())
        held.append(piece)
        chars += len(piece)
    if held:
        yield "".join(held)


def _split(text: str, size: int, overlap: int, breaks: list[str]) -> Iterator[str]:
    level = next(i for i, b in enumerate(breaks) if b in text)
    waiting: list[str] = []
    for piece in _cut_at(text, breaks[level]):
        if len(piece) < size:
            waiting.append(piece)
            continue
        yield from _packed(waiting, size, overlap)
        waiting = []
        if level + 1 < len(breaks):
            yield from _split(piece, size, overlap, breaks[level + 1:])
        else:
            yield piece
    yield from _packed(waiting, size, overlap)


def split_text(text: str, size: int, overlap: int) -> list[str]:
    """Chunks of at most ``size`` characters at the coarsest breaks that allow it, outer blanks removed."""
    if overlap > size:
        raise ValueError("overlap must not exceed size")
    return [c for c in (chunk.strip() for chunk in _split(text, size, overlap, BREAKS)) if c]


def recursive_chunks(docs: DataFrame, key: str, text: str, size: int, overlap: int, keep: list[str] = ()) -> DataFrame:
    """(key, kept columns, chunk from 0, text), cut document by document inside Arrow batches.

    One document is one unit of work; nothing is shuffled, and the metadata columns travel along.
    """
    columns = [key, *keep]
    schema = docs.select(*columns).schema.add("chunk", T.LongType()).add("text", T.StringType())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = batch["_text"].fillna("").map(lambda t: split_text(t, size, overlap))
            out = batch[columns].assign(text=parts, chunk=parts.map(lambda p: list(range(len(p)))))
            out = out.explode(["text", "chunk"]).dropna(subset=["text"])
            yield out[[*columns, "chunk", "text"]]

    return docs.select(*columns, F.col(text).alias("_text")).mapInPandas(cut, schema)


def chunk_sizes(chunks: DataFrame, strategy: str) -> DataFrame:
    """(strategy, chunks, mean_chars, max_chars) of one chunk table."""
    return chunks.agg(
        F.count("*").alias("chunks"), F.avg(F.length("text")).alias("mean_chars"),
        F.max(F.length("text")).cast("bigint").alias("max_chars"),
    ).select(F.lit(strategy).alias("strategy"), "*")


ANCHOR_WORDS = 5


def passage_places(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """(id, passage_id, passage): which texts hold which passages whole.

    ``texts`` and ``passages`` are (id, text). The inner words of a passage must be whole words of
    any text that holds it, so both meet on a hash of the first five inner words and only then are
    they compared. A passage needs three words; fewer have no inner word to meet on, which is an
    error.
    """
    n = F.least(F.size("_w") - 2, F.lit(ANCHOR_WORDS))
    checked = F.when(n >= 1, n).otherwise(F.raise_error(F.lit("a passage needs at least three words")))
    anchor = F.coalesce(*[
        F.when(F.col("_n") == k, F.xxhash64(F.lit(k), *[F.get("_w", F.lit(i + 1)) for i in range(k)]))
        for k in range(1, ANCHOR_WORDS + 1)
    ])
    anchored = passages.withColumn("_w", words(F.col("text"))).withColumn("_n", checked).select(
        F.col("id").alias("passage_id"), F.col("text").alias("passage"), "_n", anchor.alias("_anchor")
    )
    lengths = [r[0] for r in anchored.select("_n").distinct().collect()]  # at most five numbers
    if not lengths:
        lengths = [ANCHOR_WORDS]

    split = computed_once(texts.select("id", "text"), "_w", words(F.col("text")))
    runs = F.array_distinct(F.concat(*[_runs(F.col("_w"), k) for k in lengths]))
    places = split.select("id", F.explode(runs).alias("_anchor"))
    # Few passages are broadcast and the texts stay where they are; many are joined by hash.
    maybe = stage(places.join(small_side(anchored), "_anchor").select("id", "passage_id", "passage").distinct(), "maybe")
    return texts.join(small_side(maybe), "id").filter(F.contains("text", "passage")).select("id", "passage_id", "passage")


def passages_in_chunks(docs: DataFrame, places: DataFrame, size: int, stride: int) -> DataFrame:
    """Ids of the passages that stand whole in a chunk; only documents known to hold one are cut."""
    holders = docs.join(small_side(places), F.col("doc_id") == F.col("id"))
    cut = fixed_chunks(holders, "doc_id", "text", size, stride, keep=["passage_id", "passage"])
    return cut.filter(F.contains("text", "passage")).select("passage_id").distinct()


def _runs(words: Column, k: int) -> Column:
    """Hashes of all runs of k neighbouring words."""
    count = F.greatest(F.size(words) - k + 1, F.lit(0))
    names = [f"w{i}" for i in range(k)]
    runs = F.arrays_zip(*[F.slice(words, F.lit(i + 1), count).alias(name) for i, name in enumerate(names)])
    return F.transform(runs, lambda r: F.xxhash64(F.lit(k), *[r[name] for name in names]))
