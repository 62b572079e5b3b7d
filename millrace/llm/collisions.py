"""Approximate nearest neighbours by counting collisions of query-centred hash windows.

Each hash is one random projection, kept as a sorted array. A query's window on it is centred at its own
projection and grows with the radius (virtual rehashing: no other hash table is built). A vector that lies in enough
of the windows is verified by its exact distance. The radius grows until the k-th verified distance lies within it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.vectors import lengths, matrix, usable
from millrace.sources.staging import stage

#: Projections; each query's windows reach HALF radii to both sides, and each step widens the radius by RATIO.
PROJECTIONS = 48
HALF = 1.0
RATIO = 1.25
#: The share of vectors right at the radius that may miss the threshold of collisions.
MISSED = 0.01
#: Vectors, and queries, that meet in one group; and the least number of groups, so that small tables are spread.
VECTORS = 32_768
QUERIES = 2048
SPREAD = 12
SEED = 6


@dataclass
class Hashes:
    lines: np.ndarray
    threshold: int

    @classmethod
    def make(cls, dim: int) -> Hashes:
        lines = np.random.default_rng(SEED).standard_normal((dim, PROJECTIONS))
        # a vector at the radius moves by a normal step of that deviation on each line
        inside = NormalDist().cdf(HALF) - NormalDist().cdf(-HALF)
        p, least = 0.0, 0
        while p + _binomial(PROJECTIONS, least, inside) <= MISSED:
            p += _binomial(PROJECTIONS, least, inside)
            least += 1
        return cls(lines, max(1, least))


def _binomial(n: int, k: int, p: float) -> float:
    return math.comb(n, k) * p ** k * (1 - p) ** (n - k)


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
           hashes: Hashes) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, the rows and distances of its k nearest found, nearest first, ties to the smaller id."""
    places = vectors @ hashes.lines
    order = np.argsort(places, axis=0, kind="stable")
    sorted_ = np.take_along_axis(places, order, axis=0)
    asked = queries @ hashes.lines
    n, m = places.shape
    scale = np.abs(places).max(initial=0) + np.abs(asked).max(initial=0)
    out = []
    for q in range(len(queries)):
        centre = asked[q]
        mid = np.array([np.searchsorted(sorted_[:, j], centre[j]) for j in range(m)])
        # the first radius: windows that hold about k vectors on a typical line
        wide = min(n - 1, 4 * k)
        gaps = [min(abs(sorted_[max(0, min(n - 1, at - wide // 2)), j] - centre[j]), abs(sorted_[min(n - 1, at + wide // 2), j] - centre[j]))
                for j, at in enumerate(mid)]
        radius = max(float(np.median(gaps)) / HALF, scale * 1e-12, 1e-300)
        left, right = mid.copy(), mid.copy()
        count = np.zeros(n, np.int32)
        known = np.full(n, np.inf)
        known_at = np.zeros(n, bool)
        itself = ids == query_ids[q]
        while True:
            reach = radius * HALF
            met = []
            for j in range(m):
                column = sorted_[:, j]
                a, b = np.searchsorted(column, centre[j] - reach), np.searchsorted(column, centre[j] + reach, side="right")
                a, b = min(a, left[j]), max(b, right[j])
                met += [order[a:left[j], j], order[right[j]:b, j]]
                left[j], right[j] = a, b
            count += np.bincount(np.concatenate(met), minlength=n).astype(np.int32)
            new = np.flatnonzero((count >= hashes.threshold) & ~known_at)
            known_at[new] = True
            known[new] = np.sqrt(((vectors[new] - queries[q]) ** 2).sum(axis=1))
            known[new[itself[new]]] = np.inf
            done = known_at.all()
            if done or np.isfinite(known).sum() >= k and np.partition(known, k - 1)[k - 1] <= radius:
                break
            radius *= RATIO
            if not np.isfinite(radius):
                left[:], right[:] = 0, n
                count[:] = m
        best = np.flatnonzero(np.isfinite(known))
        best = best[np.lexsort((ids[best], known[best]))][:k]
        out.append((best, known[best]))
    return out


def _found(shared, dim: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        asking = np.asarray(table.column("asks").to_numpy(zero_copy_only=False), bool)
        ids, all_ = table.column("vec_id").to_numpy(), matrix(table.column("vec"), dim)
        rows = ([], [], [])
        if asking.any() and not asking.all():
            own, query_ids = ids[~asking], ids[asking]
            answers = search(all_[~asking], own, all_[asking], query_ids, k, shared.value)
            for q, (at, far) in zip(query_ids, answers):
                for out, values in zip(rows, (np.full(len(at), q), own[at], far)):
                    out.append(values)
        a, b, c = (np.concatenate(x) if x else np.zeros(0) for x in rows)
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})
    return run


def _numbers(count: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k nearest found of each query: query_id, rank (from 1), vec_id, score (Euclidean distance in doubles).

    Queries are the rows whose vec_id is divisible by ``every``; candidates all rows but those with the query's own
    vec_id; ties go to the smaller vec_id. Blocks of vectors meet blocks of queries, both of bounded size; each
    block searches its own sorted arrays without any limit on candidates, and the best k of all blocks stay.
    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without a vec_id.
    Vectors of different lengths are not compared. A query row that is repeated asks once, by its first row in the
    order of values. An empty table gives an empty result. Other columns, whatever their
    names, play no part.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors).where("vec_id is not null").select("vec_id", F.col("vec").cast("array<double>").alias("vec"), "dim"),
                 "vectors")
    out = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for dim in lengths(rows):
        own = rows.where(F.col("dim") == dim).select("vec_id", "vec")
        asked = own.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
        blocks = max(SPREAD, -(-own.count() // VECTORS))
        parts = max(1, -(-asked.count() // QUERIES))
        shared = spark.sparkContext.broadcast(Hashes.make(dim))
        held = own.select(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).alias("b"),
                          _numbers(parts).alias("p"), F.lit(False).alias("asks"), "vec_id", "vec")
        ask = asked.select(_numbers(blocks).alias("b"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("p"), F.lit(True).alias("asks"), "vec_id", "vec")
        out = out.union(held.union(ask).groupBy("b", "p").applyInArrow(_found(shared, dim, k), out.schema))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
