"""Scores per context turned into ranks, probabilities and samples; word sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.operators.ordering import range_running
from millrace.operators.sizing import computed_once


def ranked(scores: DataFrame, context: str, candidate: str, score: str) -> DataFrame:
    """Adds ``rank``: 1 for the highest score of each context, ties by candidate."""
    order = [F.col(score).desc(), F.col(candidate)]
    return range_running(scores, [context], order, {"rank": ("sum", F.lit(1).cast("bigint"))})


def softmax(scores: DataFrame, context: str, score: str, out: str = "p") -> DataFrame:
    """Scores to probabilities that sum to 1 per context, safe for large scores.

    exp(score - whole part) is summed per (context, whole part) before the shuffle; only these few
    sums per context are scaled to the largest one. No context is sorted, windowed or scanned twice.
    A score of minus infinity, as masked candidates have, is a probability of 0.
    """
    masked = F.col(score) == float("-inf")
    whole = F.floor(F.when(~masked, F.col(score)))
    sums = scores.filter(~masked).groupBy(context, whole.alias("_b")).agg(F.sum(F.exp(F.col(score) - whole)).alias("_s"))
    top = sums.withColumn("_top", F.max("_b").over(W.partitionBy(context)))
    total = top.groupBy(context, "_top").agg(F.sum(F.col("_s") * F.exp(F.col("_b") - F.col("_top"))).alias("_sum"))
    return scores.join(total, context, "left").withColumn(
        out, F.when(masked, F.when(F.col("_sum").isNotNull(), 0.0)).otherwise(F.exp(F.col(score) - F.col("_top")) / F.col("_sum"))
    ).drop("_top", "_sum")


def top_k(probabilities: DataFrame, context: str, candidate: str, k: int, p: str = "p") -> DataFrame:
    """The k likeliest candidates of each context, renormalised; k = 0 keeps all as they are."""
    if k == 0:
        return probabilities
    best = W.partitionBy(context).orderBy(F.col(p).desc(), F.col(candidate))
    kept = probabilities.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= k).drop("_rn")
    # At most k rows per context are left, so this window is small for every context.
    return kept.withColumn(p, F.col(p) / F.sum(p).over(W.partitionBy(context)))


def nucleus(probabilities: DataFrame, context: str, candidate: str, share: float, p: str = "p") -> DataFrame:
    """The smallest set of likeliest candidates whose probabilities reach ``share``."""
    order = [F.col(p).desc(), F.col(candidate)]
    running = range_running(probabilities, [context], order, {"_upto": ("sum", F.col(p))})
    before = F.round(F.col("_upto") - F.col(p), 9)
    return running.filter(before < share).drop("_upto")


def words(text: Column) -> Column:
    """Runs of anything but blanks, tabs and line ends, in order."""
    return F.array_remove(F.split(F.translate(text, "\t\n\r", "   "), " "), "")


def _neighbours(values: str, pair) -> Column:
    """``pair(a, b)`` of every element and its successor."""
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(2), n), pair)


def greedy_next(docs: DataFrame, text: str) -> DataFrame:
    """(word, next_word, n): the most frequent follower of every word, ties by the follower itself."""
    split = computed_once(docs.select(text), "_w", words(F.col(text))).select("_w")
    pairs = split.select(F.inline(_neighbours("_w", lambda a, b: F.struct(a.alias("word"), b.alias("follower")))))
    counted = pairs.groupBy("word", "follower").agg(F.count("*").alias("n"))
    best = counted.groupBy("word").agg(F.min(F.struct((-F.col("n")).alias("m"), "follower")).alias("r"))
    return best.select("word", F.col("r.follower").alias("next_word"), (-F.col("r.m")).alias("n"))


def repeated_bigrams(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents that hold a bigram twice: (key, repeated, extra) = such bigrams, surplus uses.

    Sorted inside the row, equal bigrams are neighbours: no shuffle and no exploded rows.
    """
    split = computed_once(docs.select(key, text), "_w", words(F.col(text))).select(key, "_w")
    pairs = _neighbours("_w", lambda a, b: F.concat(a, F.lit(" "), b))
    ordered = computed_once(split, "_g", F.sort_array(pairs)).select(key, "_g")
    again = _neighbours("_g", lambda a, b: F.when(a == b, a))
    hits = computed_once(ordered, "_h", F.array_compact(again)).select(key, "_h")
    return hits.filter(F.size("_h") > 0).select(
        key, F.size(F.array_distinct("_h")).cast("bigint").alias("repeated"), F.size("_h").cast("bigint").alias("extra")
    )
