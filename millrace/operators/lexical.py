"""Keyword search: the best documents per query by weighted shared words, from an inverted index.

The index is made where the documents lie: each task cuts its documents into blocks and writes, for every word of a block, the
documents with the word, what one use of it in a query would add to their scores, and the largest of these. A query's best
possible score in a block is the sum of these largest values. The most promising block of each query is scored first; its
k-th score is a limit, and blocks that cannot reach it are never opened.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.operators.sampling import words
from millrace.operators.sizing import small_side
from millrace.sources.staging import stage

# Documents in a block, at most, and characters of text, one document at least.
BLOCK = 512
BLOCK_CHARS = 1 << 22
# Queries that meet a block at a time, about, and scores and shared words held at once.
QUERIES = 2048
CELLS = 1 << 20
SHARED = 1 << 22
# Scores are compared to so many decimals.
DECIMALS = 6


@dataclass
class Index:
    """``postings`` is (block, word, top, docs, impacts), a row for each word of a block; top is the largest impact."""

    postings: DataFrame
    n_docs: int


def indexed(docs: DataFrame, block: int = BLOCK) -> Index:
    """The staged index of ``docs`` (doc_id, text): one pass, no shuffle. A row or task never holds more than a block of a word."""
    return Index(stage(_postings_of(docs, block), "postings"), docs.count())


def _postings_of(docs: DataFrame, block: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower("text").alias("text"))
    return rows.mapInArrow(_posted(block), "block long, word string, top double, docs array<long>, impacts array<double>")


def _posted(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            size = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(size[at:at + block], dtype=np.int64), BLOCK_CHARS, side="right")))
                yield _postings(batch.slice(at, n), number)
                at, number = at + n, number + 1
    return run


def _postings(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
    each = pc.split_pattern_regex(pc.fill_null(batch.column("text"), ""), "[ \t\n\r]+")
    found = each.flatten().dictionary_encode()
    doc = np.repeat(np.arange(batch.num_rows), np.diff(each.offsets.to_numpy()))
    # by word, then by place of the document, with the number of times it occurs there
    key, times = np.unique(found.indices.to_numpy().astype(np.int64) * batch.num_rows + doc, return_counts=True)
    word, doc = np.divmod(key, max(1, batch.num_rows))
    dictionary = found.dictionary
    blank = pc.index(dictionary, "").as_py()
    if blank >= 0:
        key, word, doc, times = (x[word != blank] for x in (key, word, doc, times))
    impact = 1.0 + np.log(times)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    offsets = pa.array(np.append(starts, len(word)).astype(np.int32))
    top = np.maximum.reduceat(impact, starts) if len(starts) else impact
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(starts), number)), dictionary.take(pa.array(word[starts])), pa.array(top),
        pa.ListArray.from_arrays(offsets, batch.column("doc_id").take(pa.array(doc))),
        pa.ListArray.from_arrays(offsets, pa.array(impact))], ["block", "word", "top", "docs", "impacts"])


def search(queries: DataFrame, docs: DataFrame, k: int = 2, block: int = BLOCK) -> DataFrame:
    """(qid, doc_id, score, rank): the k best documents per query, ties by doc_id.

    ``queries`` is (qid, text), ``docs`` is (doc_id, text), each id once. A shared word adds
    (1 + ln tf) * ln(1 + N / df). A document that shares no word is never found. The index is made for this search: of
    the queries' words only.
    """
    return _answered(queries, Index(_postings_of(docs, block), docs.count()), k)


def from_index(queries: DataFrame, index: Index, k: int = 2) -> DataFrame:
    """``search`` with an index that may serve many searches."""
    return _answered(queries, index, k)


def _answered(queries: DataFrame, index: Index, k: int) -> DataFrame:
    distinct = F.array_distinct(words(F.lower("text")))
    asked = stage(queries.select(F.col("qid").cast("bigint").alias("qid"), F.explode(distinct).alias("word")).distinct(), "asked")
    wanted = small_side(asked.select("word").distinct())
    # one pass over the index: what the queries' words have in it
    opened = stage(index.postings.join(wanted, "word", "left_semi"), "opened")
    tops = opened.select("word", "block", "top")
    weights = opened.groupBy("word").agg(F.log(F.lit(1.0) + F.lit(float(index.n_docs)) / F.sum(F.size("docs"))).alias("weight"))
    asked = stage(asked.join(weights, "word"), "weighed")
    chunks = max(1, -(-asked.agg(F.countDistinct("qid")).first()[0] // QUERIES))
    reach = stage(tops.join(asked, "word").groupBy("qid", "block").agg(F.sum(F.col("weight") * F.col("top")).alias("reach")), "reach")
    first = reach.groupBy("qid").agg(F.max(F.struct("reach", "block"))["block"].alias("block"))
    best = stage(_top(_scored(first, asked, opened, chunks, k), k), "first")
    limits = best.groupBy("qid").agg(F.when(F.count("*") == k, F.min("score")).alias("limit"))
    slack = 10.0 ** -DECIMALS  # scores are rounded, what a block can reach is not
    may = F.col("reach") + slack >= F.coalesce("limit", F.lit(0.0))
    rest = reach.join(first, ["qid", "block"], "left_anti").join(limits, "qid", "left").filter(may).select("qid", "block")
    return _top(best.drop("rank").unionByName(_scored(rest, asked, opened, chunks, k)), k)


def _scored(pairs: DataFrame, asked: DataFrame, opened: DataFrame, chunks: int, k: int) -> DataFrame:
    """(qid, doc_id, score): the k best of each block for the queries paired with it.

    A block's postings meet its queries, one of ``chunks`` parts at a time, in one group: both are bounded.
    """
    spark = asked.sparkSession
    chunk = F.pmod(F.xxhash64("qid"), F.lit(chunks)).alias("chunk")
    met = pairs.select("block", chunk).distinct()
    held = opened.join(met, "block").select("block", "chunk", "word", "docs", "impacts")
    ask = pairs.join(asked, "qid").select("block", chunk, "qid", "word", "weight")
    # Scoring costs more than its bytes tell, so small partitions are not put together: their number is given.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    held, ask = (side.repartition(tasks, "block", "chunk").groupBy("block", "chunk") for side in (held, ask))
    return held.cogroup(ask).applyInArrow(_best_of_block(k), "qid long, doc_id long, score double")


def _best_of_block(k: int):
    def run(held: pa.Table, ask: pa.Table) -> pa.Table:
        docs = held.column("docs").combine_chunks()
        length = np.diff(docs.offsets.to_numpy())
        ids, place = np.unique(docs.flatten().to_numpy(), return_inverse=True)
        impact = held.column("impacts").combine_chunks().flatten().to_numpy()
        start = np.cumsum(length) - length
        # each pair of a query and a word finds the word's run of documents
        run_of = pc.index_in(ask.column("word"), held.column("word")).combine_chunks()
        known = run_of.is_valid().to_numpy(zero_copy_only=False)
        qid, weight = ask.column("qid").to_numpy()[known], ask.column("weight").to_numpy()[known]
        run_of = run_of.drop_null().to_numpy()
        order = np.argsort(qid, kind="stable")
        qid, weight, run_of = qid[order], weight[order], run_of[order]
        out = ([], [], [])
        for a, b in _parts(qid, length[run_of], len(ids)):
            names, query = np.unique(qid[a:b], return_inverse=True)
            n = length[run_of[a:b]]
            shared = np.arange(n.sum()) + np.repeat(start[run_of[a:b]] - np.cumsum(n) + n, n)
            score = np.bincount(np.repeat(query, n) * len(ids) + place[shared], np.repeat(weight[a:b], n) * impact[shared], len(names) * len(ids))
            score = np.round(score, DECIMALS).reshape(len(names), len(ids))
            # documents are in the order of their ids and the sort is stable, so ties fall to the lower one
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            found = np.take_along_axis(score, best, axis=1)
            for values, column in zip((np.broadcast_to(names[:, None], best.shape), ids[best], found), out):
                column.append(values[found > 0])
        arrays = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"qid": pa.array(arrays[0], pa.int64()), "doc_id": pa.array(arrays[1], pa.int64()), "score": pa.array(arrays[2], pa.float64())})
    return run


def _parts(qid: np.ndarray, n: np.ndarray, wide: int) -> Iterator[tuple[int, int]]:
    """Cuts sorted pairs between queries, so that scores and shared words of a part are bounded, one query at least."""
    ends = np.append(np.flatnonzero(np.diff(qid)) + 1, len(qid)) if len(qid) else np.zeros(0, np.int64)
    upto = np.cumsum(n)[ends - 1] if len(ends) else ends
    at = 0
    while at < len(ends):
        begun, before = (ends[at - 1], upto[at - 1]) if at else (0, 0)
        stop = min(at + max(1, CELLS // wide), int(np.searchsorted(upto, before + SHARED, side="right")))
        stop = max(at + 1, stop)
        yield int(begun), int(ends[stop - 1])
        at = stop


def sentiment(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(doc_id, score, sentiment): the weights of a text's words added up, and positive, negative or neutral by the sign.

    ``docs`` is (doc_id, text), ``lexicon`` the caller's (word, weight), words in small letters and each once. A word counts as often as it stands.
    Words are counted by document in each task, so a long text or a frequent word is a few rows.
    """
    counted = docs.select("doc_id", F.explode(words(F.lower("text"))).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    scored = counted.join(small_side(lexicon), "word").groupBy("doc_id").agg(F.sum(F.col("n") * F.col("weight")).alias("score"))
    score = F.coalesce("score", F.lit(0))
    return docs.select("doc_id").join(scored, "doc_id", "left").select(
        "doc_id", score.alias("score"), F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral").alias("sentiment"))


def learnt_lexicon(labelled: DataFrame, least: int = 5) -> DataFrame:
    """(word, weight): 1 for words that a larger share of the good documents has than of the bad ones, -1 for the others.

    ``labelled`` is (doc_id, text, good). Words of fewer than ``least`` documents, or as frequent in both, have no weight.
    """
    seen = labelled.select(F.col("good").cast("boolean").alias("good"), F.explode(F.array_distinct(words(F.lower("text")))).alias("word"))
    by_word = seen.groupBy("word").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")).filter(F.col("g") + F.col("b") >= least)
    n_good, n_bad = labelled.agg(F.count_if(F.col("good").cast("boolean")), F.count_if(~F.col("good").cast("boolean"))).first()
    leaning = F.signum((F.col("g") * n_bad - F.col("b") * n_good).cast("double")).cast("bigint")
    return by_word.select("word", leaning.alias("weight")).filter("weight <> 0")


def _top(scored: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("qid").orderBy(F.col("score").desc(), "doc_id")
    return scored.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= k)
