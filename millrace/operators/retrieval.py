"""From ranked candidates to reranked ones, contexts, source cards and lexical search."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

# What stands for an empty context, and what separates texts in a full one.
NO_CONTEXT = "The provided documents do not contain this information."
SEPARATOR = "\n\n---\n\n"


def group_means(vectors: DataFrame, group: str, vec: str) -> DataFrame:
    """(group, vec): the mean vector per group.

    Whole vectors are summed per group inside each task, so the largest group costs no more to
    shuffle than the smallest.
    """
    means = vectors.filter(F.col(vec).isNotNull()).groupBy(group).agg(Summarizer.mean(array_to_vector(F.col(vec))).alias("_m"))
    return means.select(group, vector_to_array("_m").alias("vec"))


def rerank_by_score(candidates: DataFrame, score: Column, top_n: int | None = None) -> DataFrame:
    """New places by descending score, ties by id. All candidates stay unless ``top_n`` says so."""
    scored = candidates.withColumn("score", score)
    best = W.partitionBy("qid").orderBy(F.col("score").desc_nulls_last(), F.col("id"))
    placed = scored.withColumn("place", F.row_number().over(best).cast("bigint"))
    return placed if top_n is None else placed.filter(F.col("place") <= top_n)


def apply_rankings(candidates: DataFrame, rankings: DataFrame) -> DataFrame:
    """Candidates in the order a reranker gave.

    ``candidates``: (query_id, position from 0, doc_id, source); ``rankings``: (query_id, seq,
    index, logit, score). Positions that are null, negative or beyond the list find no partner and
    drop out of the inner join. ``relevance_score`` is the logit, or the score where there is none.
    """
    wanted = rankings.filter(F.col("index") >= 0).select(
        "query_id", "seq", F.col("index").cast("bigint").alias("position"),
        F.coalesce("logit", "score").alias("relevance_score"),
    )
    return candidates.join(wanted, ["query_id", "position"]).select(
        "query_id", "seq", "position", "doc_id", "source", "relevance_score"
    )


def stuffed_context(queries: DataFrame, chunks: DataFrame) -> DataFrame:
    """(qid, context): the texts found for each query in rank order; the fixed sentence if none.

    A context holds the k chunks of one query, which retrieval has bounded.
    """
    joined = chunks.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "text"))).alias("_found")
    ).select("qid", F.array_join(F.transform("_found", lambda s: s["text"]), SEPARATOR).alias("context"))
    return queries.join(joined, "qid", "left").withColumn("context", F.coalesce("context", F.lit(NO_CONTEXT)))


def source_card(
    number: Column, text: Column, source: Column, author: Column, page: Column, score: Column,
    title: str = "Source Document",
) -> Column:
    """A Markdown card for one retrieved chunk. Layout and the words for missing metadata are fixed values."""
    snippet = F.btrim(F.substring(text, 1, 500), F.lit(" \t\r\n"))
    score_line = F.when(score.isNull(), "").otherwise(
        F.concat(F.lit("**Relevance Score:** "), score.cast("string"), F.lit("\n"))
    )
    return F.concat(
        F.lit(f"### {title} "), number.cast("string"), F.lit("\n\n**Source:** "), F.coalesce(source, F.lit("Unknown Source")),
        F.lit("  \n**Author:** "), F.coalesce(author, F.lit("Unknown")),
        F.lit("  \n**Page:** "), F.coalesce(page.cast("string"), F.lit("N/A")), F.lit("\n"), score_line,
        F.lit("\n\n**Snippet:**  \n"), snippet, F.lit("...\n\n"),
    )
