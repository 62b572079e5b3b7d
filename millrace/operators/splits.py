"""Draws, splits, batches and packing for training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.operators.ordering import hash_order, range_running


def draw_and_split(
    usable: DataFrame, key: str, collect: int = 3000, draw: int = 1500, train: float = 0.70, validation: float = 0.15,
    seed: int = 1234,
) -> DataFrame:
    """The first ``collect`` rows by key, ``draw`` of them at random, cut by position.

    ``collect`` rows at most survive the first step (a top-n that each task cuts on its own), so
    the window over them is small whatever the table. Sizes truncate: int(0.70 n), int(0.15 n).
    """
    first = usable.orderBy(key).limit(collect)
    drawn = first.withColumn("_draw", hash_order(seed, F.col(key)))
    everything = W.partitionBy(F.lit(0))
    placed = drawn.withColumns({
        "_place": F.row_number().over(everything.orderBy("_draw", key)),
        "_n": F.least(F.lit(draw), F.count("*").over(everything)),
    }).filter(F.col("_place") <= F.col("_n"))
    n_train = F.floor(F.lit(train) * F.col("_n"))
    n_validation = F.floor(F.lit(validation) * F.col("_n"))
    split = (
        F.when(F.col("_place") <= n_train, "training")
        .when(F.col("_place") <= n_train + n_validation, "validation").otherwise("testing")
    )
    return placed.withColumn("split", split).drop("_draw", "_place", "_n")


def length_batches(docs: DataFrame, key: str, length: str, batch_size: int) -> DataFrame:
    """(batch, docs, longest, padding): examples of like length put together.

    Places follow (length, key) over all rows; they come from range pieces, so neither the table
    nor one very common length is sorted in a single task.
    """
    placed = range_running(
        docs.select(key, length), [], [F.col(length), F.col(key)], {"_place": ("sum", F.lit(1).cast("bigint"))}
    )
    batch = F.floor((F.col("_place") - 1) / batch_size)
    return placed.groupBy(batch.alias("batch")).agg(
        F.count("*").alias("docs"), F.max(length).alias("longest"),
        (F.max(length) * F.count("*") - F.sum(length)).alias("padding"),
    )


def packed(docs: DataFrame, key: str, length: str, sequence: int) -> DataFrame:
    """Examples laid end to end in key order and cut into sequences of a fixed length.

    (key, first_sequence, last_sequence, at): where each example starts and ends. Empty examples
    take no room and are left out. Places come from range pieces, whatever the keys look like; examples
    without a key come first.
    """
    some = docs.select(key, length).filter(F.col(length) > 0)
    running = range_running(some, [], [F.col(key), F.col(length)], {"_end": ("sum", F.col(length))})
    start = F.col("_end") - F.col(length)
    return running.select(
        key, F.floor(start / sequence).alias("first_sequence"),
        F.floor((F.col("_end") - 1) / sequence).alias("last_sequence"), (start % sequence).alias("at"),
    )
