"""Exact nearest neighbours from an index of pieces that the triangle inequality skips.

Vectors are put in the order of their nearest pivot and their distance to it, and cut into pieces. Of every piece the index
knows the smallest and largest distance to each pivot. A query's distance to a pivot tells how near any vector of a piece can
be: pieces that cannot hold one of its k nearest are never read. The few pieces that are most promising are read first
and give a limit; then all those that may beat it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.operators import nearest as N
from millrace.sources.staging import fresh_path, stage

# Pivots, chosen far from each other among so many vectors, the smallest by hash.
PIVOTS = 16
SAMPLE = 4096
# Rows of a piece at least, and pieces at most: beyond, pieces grow.
PIECE_ROWS = 4096
PIECES = 8192
# Pairs of a query and a piece that the driver weighs at a time.
WEIGHED = 1 << 22
# Distances are sums of rounded numbers: this share of them is allowed for.
ROUNDING = 1e-9


@dataclass
class PivotIndex:
    """``rows`` is (id, vec, piece), a folder for each piece; ``low`` and ``high`` are (pieces, pivots) distances, ``held`` rows of each piece."""

    rows: DataFrame
    pivots: np.ndarray
    pieces: np.ndarray
    low: np.ndarray
    high: np.ndarray
    held: np.ndarray

    def at_least(self, queries: np.ndarray) -> np.ndarray:
        """(queries, pieces): no vector of the piece is nearer to the query than this."""
        far = _far(queries, self.pivots)
        out = np.zeros((len(queries), len(self.pieces)))
        for i in range(len(self.pivots)):
            gap = np.maximum(far[:, i, None] - self.high[:, i], self.low[:, i] - far[:, i, None])
            out = np.maximum(out, gap - ROUNDING * (far[:, i, None] + self.high[:, i]))
        return out


def _far(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((points - o) ** 2).sum(axis=1)) for o in others], axis=1)


def _spread_pivots(sample: np.ndarray) -> np.ndarray:
    """Vectors of the sample, each the one farthest from those chosen before."""
    chosen = [0]
    nearest = _far(sample, sample[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _far(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def index(corpus: DataFrame) -> PivotIndex:
    """The index of ``corpus`` (id bigint, vec array), for squared L2. Vectors have one length and hold numbers only, else it is an error."""
    spark = corpus.sparkSession
    rows = corpus.select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast("array<double>").alias("vec")).filter("vec is not null")
    total, dims, least = rows.agg(F.count("*"), F.max(F.size("vec")), F.min(F.size("vec"))).first()
    if dims != least:
        raise ValueError("vectors differ in length")
    if not total:
        empty = np.zeros((0, 1))
        return PivotIndex(spark.createDataFrame([], "id bigint, vec array<double>, piece int"), np.zeros((0, 0)), np.zeros(0, np.int64), empty, empty, np.zeros(0, np.int64))
    rows = rows.withColumn("vec", N._sound("id"))
    pivots = _spread_pivots(np.array([r.vec for r in rows.orderBy(F.xxhash64("vec"), "id").limit(SAMPLE).collect()]))
    pieces = min(PIECES, max(1, math.ceil(total / PIECE_ROWS)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _far(N._matrix(batch.column("vec"), dims), pivots)
            home = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home), pa.array(far[np.arange(len(far)), home]), pa.array(list(far), pa.list_(pa.float64()))],
                                             ["id", "vec", "home", "ring", "far"])
    # the id parts copies of one vector, of which there may be more than a piece holds
    laid = (rows.mapInArrow(placed, "id bigint, vec array<double>, home bigint, ring double, far array<double>")
            .repartitionByRange(pieces, "home", "ring", "id").withColumn("piece", F.spark_partition_id()))
    path = fresh_path(spark, "pieces")
    laid.select("id", "vec", "far", "piece").write.partitionBy("piece").parquet(path)
    written = spark.read.schema("id bigint, vec array<double>, far array<double>, piece int").parquet(path)
    ends = [f(F.col("far")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(len(pivots))]
    known = written.groupBy("piece").agg(F.count("*").alias("n"), *ends).orderBy("piece").collect()  # a row per piece
    low, high = (np.array([[r[f"{f}{i}"] for i in range(len(pivots))] for r in known]) for f in ("min", "max"))
    return PivotIndex(written.drop("far"), pivots, np.array([r.piece for r in known]), low, high, np.array([r.n for r in known]))


def search(queries: DataFrame, store: PivotIndex, k: int, read: list[int] | None = None) -> DataFrame:
    """(qid, id, distance, rank): the k nearest of each query, exactly as ``nearest`` gives them.

    ``queries`` is (qid bigint, vec array). A block of queries is held by the driver at a time. ``read`` takes the number of rows each scan may read.
    """
    spark = queries.sparkSession
    asked = N._asked(queries)
    n, dims, least = asked.agg(F.count("*"), F.max(F.size("vec")), F.min(F.size("vec"))).first()
    if n and (dims != least or len(store.pivots) and dims != store.pivots.shape[1]):
        raise ValueError("query vectors differ in length")
    if not n or not len(store.pieces):
        return spark.createDataFrame([], f"{N.FOUND}, rank bigint")
    blocks = max(1, math.ceil(n * dims / N.BROADCAST_NUMBERS), math.ceil(n * len(store.pieces) / WEIGHED))
    found = None
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b).collect()
        if rows:
            part = _block(store, np.array([r.qid for r in rows], np.int64), np.array([r.vec for r in rows]).reshape(-1, dims), k, read)
            found = part if found is None else found.union(part)
    return N._merge(found, k)


def _block(store: PivotIndex, qids: np.ndarray, vectors: np.ndarray, k: int, read: list[int] | None) -> DataFrame:
    bound = store.at_least(vectors)
    # the nearest pieces until they hold k rows
    order = np.argsort(bound, axis=1, kind="stable")
    before = np.cumsum(store.held[order], axis=1) - store.held[order]
    first = np.zeros(bound.shape, bool)
    np.put_along_axis(first, order, before < k, axis=1)
    best = stage(_scan(store, qids, vectors, first, k, read), "first")
    limits = {r.qid: r.far for r in N._merge(best, k).filter(F.col("rank") == k).select("qid", F.sqrt("distance").alias("far")).collect()}
    limit = np.array([limits.get(q, np.inf) for q in qids.tolist()])
    rest = ~first & (bound <= limit[:, None] * (1 + ROUNDING))
    return best.union(stage(_scan(store, qids, vectors, rest, k, read), "rest")) if rest.any() else best


def _scan(store: PivotIndex, qids: np.ndarray, vectors: np.ndarray, wanted: np.ndarray, k: int, read: list[int] | None) -> DataFrame:
    """The k best of every task, for the queries that want its pieces."""
    opened = np.flatnonzero(wanted.any(axis=0))
    if read is not None:
        read.append(int(store.held[opened].sum()))
    asks = {int(store.pieces[p]): np.flatnonzero(wanted[:, p]) for p in opened}
    shared = store.rows.sparkSession.sparkContext.broadcast((qids, vectors, asks))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, who = shared.value
        best: dict[int, N._Best] = {}
        for batch in batches:
            piece = batch.column("piece").to_numpy(zero_copy_only=False)
            ids, own = batch.column("id").to_numpy(), N._matrix(batch.column("vec"), matrix.shape[1])
            for p in np.unique(piece).tolist():
                if p not in best:
                    best[p] = N._Best(matrix[who[p]], k, "l2")
                best[p].add(ids[piece == p], own[piece == p])
        for p, one in best.items():
            if len(one.q):
                yield pa.RecordBatch.from_arrays([pa.array(names[who[p]][one.q]), pa.array(one.i), pa.array(one.d)], ["qid", "id", "distance"])

    # folders of other pieces are never listed into the scan
    return store.rows.filter(F.col("piece").isin([int(store.pieces[p]) for p in opened])).mapInArrow(scan, N.FOUND)
