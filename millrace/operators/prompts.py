"""Prompts built from several rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def few_shot(solved: DataFrame, open_ones: DataFrame, key: str, n: int) -> DataFrame:
    """Adds ``prompt``: the first n solved examples, then the open question.

    ``solved`` is (key, text, answer boolean). The block of n examples is a scalar sub-query, so
    the open questions are neither shuffled nor joined.
    """
    answer = F.when(F.col("answer"), "True").otherwise("False")
    shots = solved.orderBy(key).limit(n).select(
        key, F.concat(F.lit("Q: "), "text", F.lit("\nAnswer: "), answer).alias("shot")
    )
    block = shots.agg(F.array_sort(F.collect_list(F.struct(key, "shot"))).alias("s")).select(
        F.array_join(F.transform("s", lambda x: x["shot"]), "\n\n").alias("b")
    ).scalar()
    return open_ones.withColumn("prompt", F.concat(block, F.lit("\n\nQ: "), "text", F.lit("\nAnswer: ")))
