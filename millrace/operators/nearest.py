"""Exact nearest-neighbour search as a Spark job.

Pairs are never emitted. Each task scores its share of the corpus against a block of queries with
numpy, keeps the best k per query, and only those rows are shuffled and merged. The corpus is neither
shuffled nor copied: a block of queries of bounded size is sent to it, one scan per block, and what a scan has
found is written down before the next block is read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.sources.staging import fresh_path, stage

# Largest block of queries that is broadcast: 4M numbers = 32 MB as doubles.
BROADCAST_NUMBERS = 4_000_000
# Pairs scored at once inside a task.
BLOCK_PAIRS = 1 << 20
# Queries scored at once: with this many, a block of pairs is as wide as it is long, and what is best so far is merged seldom.
GROUP_QUERIES = 1 << 10
# Rows of a corpus from which each query gets its first limit.
FIRST_ROWS = 1 << 8
# Numbers held at once while pairs are scored again.
EXACT_NUMBERS = 1 << 22
# Parts of the corpus for each core: each part finds k rows for every query anew, however small it is.
PARTS_PER_CORE = 3


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; all zeros stay. Scaled first, so that no size over- or underflows."""
    most = np.abs(vectors).max(axis=1, initial=0.0, keepdims=True)
    scaled = np.divide(vectors, most, out=np.zeros_like(vectors), where=most > 0)
    size = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return np.divide(scaled, size, out=np.zeros_like(scaled), where=size > 0)


def _bounds(corpus: np.ndarray, queries: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(queries x corpus) distances by one matrix product, and how far rounding may have put each off."""
    dot = queries @ corpus.T
    ulp = np.finfo(np.float64).eps * (corpus.shape[1] + 8)
    if metric == "cosine":
        return 1.0 - dot, np.full((1, 1), 4 * ulp)
    norms = (queries * queries).sum(axis=1)[:, None] + (corpus * corpus).sum(axis=1)[None, :]
    return norms - 2.0 * dot, 2 * ulp * norms


def _exact(corpus: np.ndarray, ci: np.ndarray, queries: np.ndarray, qi: np.ndarray, metric: str) -> np.ndarray:
    """Distances of pairs, given by their rows: squared differences, or one minus the cosine of unit vectors."""
    out = np.empty(len(ci))
    step = max(1, EXACT_NUMBERS // max(1, corpus.shape[1]))
    for lo in range(0, len(ci), step):
        c, q = corpus[ci[lo:lo + step]], queries[qi[lo:lo + step]]
        out[lo:lo + step] = ((q - c) ** 2).sum(axis=1) if metric == "l2" else 1.0 - (q * c).sum(axis=1)
    return out


class _Rows:
    """Vectors of a corpus, and what all groups of queries need to know of them."""

    def __init__(self, vectors: np.ndarray, metric: str):
        self.vectors = _unit(vectors) if metric == "cosine" else vectors
        with np.errstate(over="ignore", invalid="ignore"):
            self.norms = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.most = float(np.abs(self.vectors).max(initial=0.0))
        self.finite = bool(np.isfinite(self.norms).all())
        self.metric, self._small = metric, {}

    def small(self, size: float) -> tuple[float, np.ndarray]:
        """A unit of length, and the rows for products with queries in single precision that were divided by ``size``: twice the
        vector, and minus its squared norm, both in squared units. By the cosine: the vector and nothing."""
        if size not in self._small:
            unit = max(size, self.most)
            more = np.zeros_like(self.norms) if self.metric == "cosine" else -(self.norms / unit / unit)
            by = 1.0 if self.metric == "cosine" else 2.0 * (size / unit) / unit
            self._small = {size: (unit, np.hstack([self.vectors * by, more[:, None]]).astype(np.float32))}
        return self._small[size]


class _Best:
    """The k closest ids per query seen so far, by exact distances, ties by id.

    A matrix product in single precision tells which pairs may be among the best, by a bound on its error; these are scored exactly.
    """

    #: Where pairs are scored, for all groups of queries of a worker one after the other.
    room: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        if metric not in ("l2", "cosine"):
            raise ValueError(f"unknown metric {metric!r}")
        self.queries, self.k, self.metric = _unit(queries) if metric == "cosine" else queries, k, metric
        self.q = np.empty(0, dtype=np.int64)
        self.d = np.empty(0, dtype=np.float64)
        self.i = np.empty(0, dtype=np.int64)
        self.limit = np.full(len(queries), np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            self.norms = np.einsum("ij,ij->i", self.queries, self.queries)
        self.finite = bool(np.isfinite(self.norms).all())
        # squares of anything smaller than the least size are nothing
        self.size = 1.0 if metric == "cosine" else float(np.abs(self.queries).max(initial=1e-150))
        self._small: np.ndarray | None = None

    def add(self, ids: np.ndarray, vectors: np.ndarray | _Rows) -> None:
        rows = vectors if isinstance(vectors, _Rows) else _Rows(vectors, self.metric)
        step, at = max(1, BLOCK_PAIRS // max(1, len(self.queries))), 0
        held, waiting = [], 0
        while at < len(ids):
            if rows.finite and self.finite and not np.isinf(self.limit).any():
                upto = min(at + step, len(ids))
                qi, ci = self._close(rows, at, upto)
            else:
                upto = min(at + min(step, max(FIRST_ROWS, 4 * self.k)), len(ids))
                qi, ci = self._maybe(rows.vectors[at:upto])
            if len(qi):
                held.append((qi, ci + at))
                waiting += len(qi)
            at = upto
            if held and (at >= len(ids) or waiting >= self.k * len(self.queries) or np.isinf(self.limit).any()):
                self._merge(*(np.concatenate(x) for x in zip(*held)), ids, rows.vectors)
                held, waiting = [], 0

    def _close(self, rows: _Rows, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of queries and of the rows from ``low`` to ``high`` that may be among the best, by single precision."""
        unit, small = rows.small(self.size)
        if self._small is None:
            one = np.ones((len(self.queries), 1))
            self._small = np.hstack([self.queries / self.size, one]).astype(np.float32)
        # each of dims + 1 products and sums is off by a rounding, and so are the numbers themselves
        off = 4 * np.finfo(np.float32).eps * (self.queries.shape[1] + 16)
        if self.metric == "cosine":
            least = 1.0 - self.limit - off
        else:
            norms = self.norms / unit / unit
            least = norms - self.limit / unit / unit - off * (norms + float(rows.norms[low:high].max()) / unit / unit)
        # rounded down; what is too small for single precision is off by less than the last term
        with np.errstate(over="ignore"):
            least = np.nextafter((least - 1e-30).astype(np.float32), np.float32(-np.inf))
        shape = len(self.queries), high - low
        pairs = shape[0] * shape[1]
        if not _Best.room or len(_Best.room[0]) < pairs:
            _Best.room = np.empty(pairs, np.float32), np.zeros(pairs + 8, bool)
        product, maybe = (x[:pairs].reshape(shape) for x in _Best.room)
        np.matmul(self._small, small[low:high].T, out=product)
        np.greater_equal(product, least[:, None], out=maybe)
        # few are: eight are passed over at a time
        eights = _Best.room[1][:pairs + -pairs % 8]
        eights[pairs:] = False
        eights = eights.reshape(-1, 8)
        some = np.flatnonzero(eights.view(np.uint64))
        at, one = np.nonzero(eights[some])
        return np.divmod(8 * some[at] + one, shape[1])

    def _maybe(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be among the best, by double precision and also by what the rows themselves leave room for."""
        rough, off = _bounds(some, self.queries, self.metric)
        maybe = rough - off <= self.limit[:, None]
        if rough.shape[1] > self.k and np.count_nonzero(maybe) > 4 * self.k * len(self.queries):
            # k of this block are surely as near as this
            limit = np.minimum(self.limit, np.partition(rough + off, self.k - 1, axis=1)[:, self.k - 1])
            maybe = rough - off <= limit[:, None]
        return np.nonzero(maybe)

    def _merge(self, qi: np.ndarray, ci: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        far = _exact(vectors, ci, self.queries, qi, self.metric)
        near = far <= self.limit[qi]
        q = np.concatenate([self.q, qi[near]])
        d = np.concatenate([self.d, far[near]])
        i = np.concatenate([self.i, ids[ci[near]]])
        order = np.lexsort((i, d, q))
        q, d, i = q[order], d[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        keep = place < self.k
        self.q, self.d, self.i = q[keep], d[keep], i[keep]
        full = place == self.k - 1
        self.limit[q[full]] = d[full]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _merge(partial: DataFrame, k: int) -> DataFrame:
    closest = W.partitionBy("qid").orderBy("distance", "id")
    return (
        partial.withColumn("rank", F.row_number().over(closest))
        .filter(F.col("rank") <= k)
        .select("qid", "id", "distance", F.col("rank").cast("bigint").alias("rank"))
    )


def _sound(key: str) -> Column:
    """The vector, or an error that names the row whose vector holds something else than numbers."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x))
    return F.when(~bad, F.col("vec")).otherwise(
        F.raise_error(F.concat(F.lit(f"not a number in the vector of {key} "), F.col(key).cast("string"))))


def _asked(queries: DataFrame, scoped: bool = False) -> DataFrame:
    """Queries on disk: they are measured first and read again, but computed once."""
    sees = F.col("sees").cast("array<string>") if scoped else F.lit(None).cast("array<string>")
    whole = queries.select(F.col("qid").cast("bigint"), F.col("vec").cast("array<double>"), sees.alias("sees")).filter("vec is not null")
    return stage(whole.withColumn("vec", _sound("qid")), "queries")


@dataclass
class Block:
    """Queries that go to the corpus together; ``sees`` holds what each may see, where that is limited."""

    qids: np.ndarray
    matrix: np.ndarray
    sees: list[list[str] | None]


Score = Callable[[Block, Iterator[pa.RecordBatch], int], Iterator[pa.RecordBatch]]

# Up to this many different values the corpus is cut by a filter that files can skip by, beyond by a join.
FILTER_VALUES = 1000


def _in_sight(corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """The rows that some query may see."""
    values = queries.select(F.explode("sees").alias("of")).filter("of is not null").distinct()
    few = [r.of for r in values.limit(FILTER_VALUES + 1).collect()]
    return corpus.filter(F.col("of").isin(few)) if len(few) <= FILTER_VALUES else corpus.join(values, "of", "left_semi")


def _scans(queries: DataFrame, corpus: DataFrame, score: Score, schema: str, block_numbers: int, scoped: bool = False) -> DataFrame:
    """What ``score`` makes of every block of queries and every part of the corpus.

    ``score`` gets the block, the batches of a task and the vectors' length. The driver
    holds one block at a time; all results are read from one folder.
    """
    spark = queries.sparkSession
    numbers = F.size("vec") + 8 * F.coalesce(F.size("sees"), F.lit(0)) if scoped else F.size("vec")
    n_queries, dims, least, total = queries.agg(F.count("*"), F.max(F.size("vec")), F.min(F.size("vec")), F.sum(numbers)).first()
    if not n_queries:
        return spark.createDataFrame([], schema)
    if dims != least:
        raise ValueError("query vectors differ in length")
    if scoped:
        corpus = _in_sight(corpus, queries)
    more = [F.col("of").cast("string").alias("of")] if scoped else []
    corpus = corpus.select(F.col("id").cast("bigint"), F.col("vec"), *more).filter("vec is not null")
    # A vector of another length than the queries is an error of the store, not a far neighbour.
    corpus = corpus.withColumn(
        "vec",
        F.when(F.size("vec") == dims, _sound("id"))
        .otherwise(F.raise_error(F.concat(F.lit("wrong vector length for id "), F.col("id").cast("string")))),
    )
    corpus = corpus.coalesce(PARTS_PER_CORE * spark.sparkContext.defaultParallelism)  # fewer stay as they are
    blocks = max(1, math.ceil(total / block_numbers))
    path = fresh_path(spark, "scans")
    for b in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b).toArrow()
        if not rows.num_rows:
            continue
        qids, vec, sees = (pa.concat_arrays(rows.column(c).chunks) for c in ("qid", "vec", "sees"))
        if qids.null_count:
            raise TypeError("a query without a qid")
        block = Block(qids.to_numpy(), _matrix(vec, dims), sees.to_pylist())
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from score(shared.value, batches, dims)

        part = corpus.mapInArrow(scan, schema)
        if blocks == 1:
            return part
        part.write.mode("append").parquet(path)
        shared.unpersist()
    return spark.read.schema(schema).parquet(path)


class _Sight:
    """Which rows of a batch go to which queries; queries that see the same are one group."""

    def __init__(self, sees: list[list[str] | None]):
        members: dict[frozenset, list[int]] = {}
        for at, values in enumerate(sees):
            members.setdefault(frozenset(values or ()) - {None}, []).append(at)
        self.groups = [np.array(at) for at in members.values()]
        self.of: dict[str, list[int]] = {}
        for group, values in enumerate(members):
            for value in values:
                self.of.setdefault(value, []).append(group)

    def rows(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(group, the rows it sees), for the groups that see any."""
        values = column.dictionary_encode()
        codes = values.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        seen: dict[int, list[np.ndarray]] = {}
        for code, value in enumerate(values.dictionary.to_pylist()):
            groups = self.of.get(value)
            if groups:
                rows = np.flatnonzero(codes == code)
                for group in groups:
                    seen.setdefault(group, []).append(rows)
        for group, rows in seen.items():
            yield group, np.concatenate(rows)


FOUND = "qid bigint, id bigint, distance double"


def nearest(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str = "l2", broadcast_numbers: int = BROADCAST_NUMBERS,
    scoped: bool = False,
) -> DataFrame:
    """(qid, id, distance, rank) of the k closest corpus vectors per query, ties by id.

    ``queries`` is (qid bigint, vec array), ``corpus`` is (id bigint, vec array). Distances are exact in
    double precision at any scale of the values, and ranked as they are, unrounded.

    With ``scoped``, a query also carries the values it may see (``sees``, an array) and a corpus row the one it has
    (``of``): all queries are answered by one scan of the rows that any of them may see, each from its own.
    Rows without a value are seen by no query, and a query that may see nothing finds nothing.
    """
    def found(block: Block, at: np.ndarray, best: _Best) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block.qids[at][best.q]), pa.array(best.i), pa.array(best.d)], ["qid", "id", "distance"])

    def score(block, batches, dims):
        sight = _Sight(block.sees) if scoped else None
        groups = [[at[i:i + GROUP_QUERIES] for i in range(0, len(at), GROUP_QUERIES)]
                  for at in (sight.groups if scoped else [np.arange(len(block.qids))])]
        best = [[_Best(block.matrix[at], k, metric) for at in parts] for parts in groups]
        for batch in batches:
            if batch.num_rows:
                ids, vectors = batch.column("id").to_numpy(), _matrix(batch.column("vec"), dims)
                for group, rows in sight.rows(batch.column("of")) if scoped else [(0, slice(None))]:
                    some = _Rows(vectors[rows], metric)
                    for one in best[group]:
                        one.add(ids[rows], some)
        for parts, ones in zip(groups, best):
            for at, one in zip(parts, ones):
                if len(one.q):
                    yield found(block, at, one)

    return _merge(_scans(_asked(queries, scoped), corpus, score, FOUND, broadcast_numbers, scoped), k)


def compare_all(queries: DataFrame, corpus: DataFrame, broadcast_numbers: int = BROADCAST_NUMBERS) -> DataFrame:
    """Every query against every vector, summarised: (qid, n, nearest, farthest, mean) of squared L2.

    One row per query and task leaves a scan; the pairs themselves are never rows.
    """
    def score(block, batches, dims):
        qids, matrix = block.qids, block.matrix
        n, total = 0, np.zeros(len(qids))
        low, high = np.full(len(qids), np.inf), np.full(len(qids), -np.inf)
        for batch in batches:
            data = _matrix(batch.column("vec"), dims)
            n += len(data)
            for at, query in enumerate(matrix if len(data) else ()):
                dist = ((data - query) ** 2).sum(axis=1)
                total[at] += dist.sum()
                low[at], high[at] = min(low[at], dist.min()), max(high[at], dist.max())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(qids), pa.array(np.full(len(qids), n)), pa.array(low), pa.array(high), pa.array(total)],
                ["qid", "n", "low", "high", "total"],
            )

    schema = "qid bigint, n bigint, low double, high double, total double"
    return _scans(_asked(queries), corpus, score, schema, broadcast_numbers).groupBy("qid").agg(
        F.sum("n").alias("n"), F.min("low").alias("nearest"), F.max("high").alias("farthest"),
        (F.sum("total") / F.sum("n")).alias("mean"),
    )
