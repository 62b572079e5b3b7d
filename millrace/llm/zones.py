"""Clustering around centroids, with zone maps along a space-filling curve.

Vectors are put in the order of a Hilbert curve through their leading axes and cut into small blocks, each with its
box: the smallest and largest value on every axis. In each round a block's box is held against the centroids: the
centroid with the smallest largest distance leads, and any other that is farther than it at every point of the box
cannot be anyone's nearest there. The vectors of the block are compared exactly, in whole numbers, with the rest.

The axes are the principal axes of a bounded sample. They are a rotation, so distances keep; boxes are tight on the
axes the curve follows, and only the choice of candidates, never an answer, depends on them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.packing import hilbert_key
from millrace.llm.vectors import finite, floors, lists, matrix
from millrace.sources.staging import stage

#: The axes are fitted on at most this many vectors, the smallest by hash; all vectors are placed by them.
SAMPLE = 4096
#: The curve runs through so many axes, each cut into 2^BITS steps of equal numbers of sampled vectors.
AXES = 6
BITS = 10
#: Vectors in a block.
BLOCK = 32
#: Vectors that are keyed, or blocks that are assigned, at a time.
AT_A_TIME = 4096


@dataclass
class Curve:
    """A rotation to the sample's principal axes, and the steps on the leading ones."""

    middle: np.ndarray
    axes: np.ndarray
    steps: list[np.ndarray]

    @classmethod
    def fit(cls, whole: np.ndarray) -> Curve:
        middle = whole.mean(axis=0)
        away = whole - middle
        spread, axes = np.linalg.eigh(away.T @ away)
        axes = axes[:, ::-1]
        leading = away @ axes[:, :AXES]
        shares = np.arange(1, 1 << BITS) / (1 << BITS)
        return cls(middle, axes, [np.quantile(column, shares) for column in leading.T])

    def turned(self, whole: np.ndarray) -> np.ndarray:
        return (whole - self.middle) @ self.axes

    def keys(self, whole: np.ndarray) -> np.ndarray:
        turned = self.turned(whole)
        places = [np.searchsorted(step, turned[:, i]) for i, step in enumerate(self.steps)]
        return hilbert_key(np.stack(places, axis=1), BITS)


def box_candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(boxes, centroids): whether some point of the box may have this centroid as its nearest.

    The squared distance to the leading centroid p less that to another one c is linear in the point, so its
    largest value over a box is reached at a corner, one side per axis. Below zero, c is nowhere nearer.
    """
    farthest = sum(np.maximum((low[:, None, i] - centroids[:, i]) ** 2, (high[:, None, i] - centroids[:, i]) ** 2)
                   for i in range(low.shape[1]))
    lead = centroids[farthest.argmin(axis=1)]
    slope = 2 * (centroids[None, :, :] - lead[:, None, :])
    gain = np.maximum(slope * low[:, None, :], slope * high[:, None, :]).sum(axis=2)
    gain += (lead ** 2).sum(axis=1)[:, None] - (centroids ** 2).sum(axis=1)
    # rounding errors are far below this share of the terms
    slack = 1e-9 * (np.maximum(np.abs(low), np.abs(high)).max(axis=1) + np.abs(centroids).max() + 1) ** 2 * low.shape[1]
    return gain >= -slack[:, None]


def assign(whole: np.ndarray, block: np.ndarray, candidates: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector, by exact comparison with its block's candidates."""
    cluster = np.zeros(len(whole), np.int32)
    distance = np.full(len(whole), np.iinfo(np.int64).max)
    for c, centroid in enumerate(centroids):
        rows = np.flatnonzero(candidates[block, c])
        far = ((whole[rows] - centroid) ** 2).sum(axis=1)
        nearer = far < distance[rows]  # centroids come in order: ties stay with the smaller number
        cluster[rows[nearer]], distance[rows[nearer]] = c, far[nearer]
    return cluster, distance


def _keyed(curve: Curve, dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_A_TIME):
                some = batch.slice(at, AT_A_TIME)
                whole = floors(matrix(some.column("vec"), dim), scale)
                yield pa.RecordBatch.from_arrays(
                    [some.column("salt"), some.column("vec_id"), pa.array(curve.keys(whole)), lists(whole.astype(np.int32))],
                    ["salt", "vec_id", "key", "whole"])
    return run


def _blocks(curve: Curve, dim: int):
    """Cuts a task's stretch of the curve into blocks: the ids, the vectors one after the other, and the box."""
    names = ["vec_ids", "whole", "low", "high"]

    def made(ids: list, whole: np.ndarray) -> pa.RecordBatch:
        turned, starts = curve.turned(whole), np.arange(0, len(ids), BLOCK)
        ends = [*starts, len(ids)]
        return pa.RecordBatch.from_arrays([
            pa.array([ids[a:b] for a, b in zip(ends, ends[1:])], pa.list_(pa.int64())),
            pa.ListArray.from_arrays(pa.array(np.array(ends) * dim, pa.int32()), pa.array(whole.astype(np.int32).ravel())),
            lists(np.minimum.reduceat(turned, starts)), lists(np.maximum.reduceat(turned, starts))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, whole = [], np.zeros((0, dim), np.int64)
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            whole = np.concatenate([whole, np.asarray(batch.column("whole").flatten()).reshape(-1, dim)])
            full = len(ids) - len(ids) % BLOCK
            if full:
                yield made(ids[:full], whole[:full])
                ids, whole = ids[full:], whole[full:]
        if ids:
            yield made(ids, whole)
    return run


def _assigned(curve: Curve, centroids: np.ndarray) -> Callable[[pa.RecordBatch], Iterator[tuple]]:
    """For a batch of blocks: (ids, vectors, clusters, distances), some blocks at a time."""
    dim, turned = centroids.shape[1], curve.turned(centroids)

    def work(batch: pa.RecordBatch) -> Iterator[tuple]:
        for at in range(0, batch.num_rows, AT_A_TIME // BLOCK):
            some = batch.slice(at, AT_A_TIME // BLOCK)
            ids = some.column("vec_ids")
            block = np.repeat(np.arange(len(some)), np.diff(ids.offsets.to_numpy()))
            whole = np.asarray(some.column("whole").flatten()).reshape(-1, dim).astype(np.int64)
            box = [matrix(some.column(c), dim) for c in ("low", "high")]
            yield ids.flatten(), whole, *assign(whole, block, box_candidates(*box, turned), centroids)
    return work


def _sums(curve: Curve, centroids: np.ndarray):
    """One row per cluster and task: how many vectors, and their components' sums."""
    work = _assigned(curve, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, whole, cluster, _ in work(batch):
                n += np.bincount(cluster, minlength=len(n))
                np.add.at(total, cluster, whole)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), lists(total[used])],
                                         ["cluster", "n", "total"])
    return run


def _found(curve: Curve, centroids: np.ndarray):
    work = _assigned(curve, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, cluster, distance in work(batch):
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])
    return run


def zone_map(rows: DataFrame, dim: int, scale: int) -> tuple[Curve, DataFrame]:
    """The curve fitted on a sample of ``rows`` (vec_id, vec), and all rows in staged blocks along it.

    Ranges are cut by the key and then by a hash of the row, so copies of one vector may fill several tasks.
    """
    sample = rows.orderBy(F.xxhash64("vec")).limit(SAMPLE).select("vec").toArrow()
    curve = Curve.fit(floors(matrix(sample.column("vec"), dim), scale))
    keyed = (rows.withColumn("salt", F.xxhash64("vec_id", F.monotonically_increasing_id())).select("salt", "vec_id", "vec")
             .mapInArrow(_keyed(curve, dim, scale), "salt long, vec_id long, key long, whole array<int>"))
    ordered = keyed.repartitionByRange("key", "salt").sortWithinPartitions("key").select("vec_id", "whole")
    return curve, stage(ordered.mapInArrow(_blocks(curve, dim), "vec_ids array<long>, whole array<int>, low array<double>, high array<double>"),
                        "zones")


def _seeds(rows: DataFrame, dim: int, scale: int, k: int) -> np.ndarray:
    """The vectors with the k smallest hashes; rows without a vec_id come last, ties by value."""
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(hashed.alias("hash"), "vec").orderBy(F.col("hash").asc_nulls_last(), "vec").limit(k).collect()
    return floors(np.array([r.vec for r in first], np.float64).reshape(-1, dim), scale)


def cluster(vectors: DataFrame, dim: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> DataFrame:
    """One row per vector of exactly ``dim`` finite components: vec_id, cluster, distance (squared, to the final
    centroid), cluster_inertia and inertia (distances summed over the cluster and over all), centroid_sha256.

    A component x counts as floor(scale * x). The k vectors whose vec_id has the smallest SHA-256 (of ``1:<vec_id>``) are the
    first centroids; each round assigns every vector to the nearest one, ties to the smaller number, and moves every
    centroid that has vectors to the floor of their mean; then all are assigned once more.

    Other vectors (null, of another length, with null or non-finite components) give no row. Repeated rows count, and
    give a row, each time; rows without a vec_id are clustered, and seed only where fewer than k others are; rows with one vec_id
    seed in the order of their values. With fewer than k vectors there are as many centroids as vectors. Components
    whose squared distances would not fit 64 bits are an error. Other columns, whatever their names, play no part. An empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = finite(vectors).where(F.col("dim") == dim).select("vec_id", "vec")
    centroids = _seeds(rows, dim, scale, k)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    curve, blocks = zone_map(rows, dim, scale)
    for _ in range(rounds):
        centroids = _moved(blocks, curve, centroids)
    found = stage(blocks.mapInArrow(_found(curve, centroids), "vec_id long, cluster int, distance long"), "clusters")
    return found.join(F.broadcast(_summary(spark, found, centroids)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(blocks: DataFrame, curve: Curve, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round; one row of sums for each comes to the driver."""
    sums = blocks.mapInArrow(_sums(curve, centroids), "cluster int, n long, total array<long>")
    each = [F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(centroids.shape[1])]
    moved = centroids.copy()
    for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect():
        moved[r.cluster] = [r[f"c{i}"] // r.n for i in range(centroids.shape[1])]
    return moved


def _summary(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """What rows of a cluster share; one row for each of the k clusters in use."""
    sums = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(c, d, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, d in sums.items()]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
