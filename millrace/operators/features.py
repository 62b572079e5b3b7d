"""One row per person: usage features, labels, encodings and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.ordering import blocked_running, hash_block, hash_order

USAGE = ["minutes_30d", "sessions_30d", "completion_rate", "distinct_titles_30d"]


def squash(events: DataFrame) -> DataFrame:
    """Many rows per person to one; a null person is dropped as a dataframe groupby would."""
    return (
        events.filter(F.col("subscriber_id").isNotNull())
        .groupBy("subscriber_id")
        .agg(
            F.coalesce(F.sum("watch_minutes"), F.lit(0.0)).alias("minutes_30d"),
            F.count("watch_minutes").alias("sessions_30d"),
            F.avg("completed").alias("completion_rate"),
            F.countDistinct("content_id").alias("distinct_titles_30d"),
        )
    )


def attach_usage(subscribers: DataFrame, usage: DataFrame) -> DataFrame:
    """Everyone stays; no usage means zeros, because absence is the signal."""
    return subscribers.join(usage, "subscriber_id", "left").fillna(0, subset=USAGE)


def group_summary(training: DataFrame, label: str) -> DataFrame:
    return training.groupBy(label).agg(
        F.count("*").alias("people"),
        F.bround(F.avg("minutes_30d"), 1).alias("minutes"),
        F.bround(F.avg("sessions_30d"), 1).alias("sessions"),
    )


def label_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("people"), F.avg(label).alias("rate"), F.sum(label).cast("bigint").alias("positives")
    )


def observed_values(df: DataFrame, column: str, at_most: int = 1000) -> list[str]:
    """Sorted distinct values of a category; more than ``at_most`` is an error, never cut."""
    rows = df.select(F.col(column).cast("string")).distinct().dropna().limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"{column} has more than {at_most} values and is no category")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    """One 0/1 column per observed value, none dropped; a null row is all zeros."""
    values = observed_values(df, column) if values is None else values
    flags = [
        F.coalesce((F.col(column).cast("string") == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values
    ]
    return df.select(*[c for c in df.columns if c != column], *flags)


def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed: int) -> DataFrame:
    """Adds ``split``: the same share of every label goes to ``test``, drawn by a seeded hash.

    Places are counted in hash blocks, so a label holding most rows is not sorted in one task.
    """
    drawn = df.withColumn("_draw", hash_order(seed, F.col(key)))
    drawn = drawn.withColumn("_block", hash_block(F.col("_draw")))
    one = F.lit(1).cast("bigint")
    placed = blocked_running(drawn, [label], [F.col("_draw"), F.col(key)], ["_block"], {
        "_place": ("sum", one), "_rows": ("all_sum", one),
    })
    n_test = F.round(F.col("_rows") * F.lit(test_share))
    return placed.withColumn("split", F.when(F.col("_place") <= n_test, "test").otherwise("train")).select(
        *df.columns, "split"
    )


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean, unit deviation (population); a constant column becomes zeros.

    Means and deviations are scalar sub-queries of one aggregate each, not a window over all rows.
    """
    out = df
    for c in columns:
        stats = df.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"))
        mean, dev = stats.select("m").scalar(), stats.select("s").scalar()
        out = out.withColumn(f"{c}_scaled", F.when(dev > 0, (F.col(c) - mean) / dev).otherwise(F.lit(0.0)))
    return out
