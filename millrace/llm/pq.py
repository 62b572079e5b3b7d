"""Near-duplicate embeddings by product quantisation.

A coarse quantiser deals vectors (of unit length) to inverted lists; what it leaves of a vector, the residual, is
coded by one of up to 256 centres in each subspace. A vector visits its own list and those whose border is so near
that a neighbour may well lie behind it. There, distances to the coded vectors are sums of table entries;
as each code's error is stored, the sum bounds the true distance, and no pair under the limit is passed over.
What passes is compared by its exact cosine.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.components import components, local_stars
from millrace.llm.vectors import lengths, matrix, usable, unusable
from millrace.sources.staging import stage

#: The quantisers are fitted on at most this many different vectors, the smallest by hash; all are indexed.
SAMPLE = 20_000
LISTS = 4096
SUBSPACE = 4
CENTRES = 256
#: A list is visited if its border is at most this many standard deviations of a neighbour's step away. The step of
#: a neighbour at the limit has the length r and, in any one direction, a deviation of r / sqrt(dim). Either of two
#: neighbours may find the other, so a pair is missed only if its step crosses the border by twice as much.
REACH = 2.0
#: Rows of a list, and visitors to it, that meet in one group.
MEMBERS = 4096
VISITORS = 8192


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        label = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, points)
        count = np.bincount(label, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([np.argmax(points[i:i + 4096] @ centres.T - half, axis=1) for i in range(0, len(points), 4096)]
                          or [np.zeros(0, np.int64)])


@dataclass
class Index:
    """Coarse centres, the subspaces' columns, and each subspace's centres."""

    coarse: np.ndarray
    columns: list[np.ndarray]
    centres: list[np.ndarray]
    radius: float

    @classmethod
    def fit(cls, unit: np.ndarray, total: int, cosine: float) -> Index:
        dim = unit.shape[1]
        coarse = kmeans(unit, max(1, min(LISTS, 1 << round(math.log2(max(1, total)) / 2), len(unit) // 4)), 8, 1)
        rest = unit - coarse[nearest(unit, coarse)]
        columns = np.array_split(np.arange(dim), math.ceil(dim / SUBSPACE))
        centres = [kmeans(rest[:, c], CENTRES, 5, 2) for c in columns]
        return cls(coarse, columns, centres, math.sqrt(max(0.0, 2 - 2 * cosine)))

    def home(self, unit: np.ndarray) -> np.ndarray:
        return nearest(unit, self.coarse)

    def visits(self, unit: np.ndarray, home: np.ndarray) -> np.ndarray:
        """For each vector, which lists it visits. The border of a list lies half way between the centres."""
        score = unit @ self.coarse.T - (self.coarse ** 2).sum(axis=1) / 2
        own, square = self.coarse[home], (self.coarse ** 2).sum(axis=1)
        gap = np.sqrt(np.maximum(square[home][:, None] + square - 2 * own @ self.coarse.T, 0))
        border = score[np.arange(len(unit)), home][:, None] - score
        return border <= gap * (REACH * self.radius / math.sqrt(unit.shape[1])) + 1e-12

    def encode(self, unit: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each vector from what its codes say."""
        rest = unit - self.coarse[home]
        codes = np.stack([nearest(rest[:, c], k) for c, k in zip(self.columns, self.centres)], axis=1)
        said = np.concatenate([k[codes[:, i]] for i, k in enumerate(self.centres)], axis=1)
        return codes.astype(np.uint8), np.linalg.norm(rest - said, axis=1)

    def candidates(self, unit: np.ndarray, at: int, codes: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, member) of one list whose true distance may be within the radius."""
        rest = unit - self.coarse[at]
        found = np.zeros((len(unit), len(codes)), np.float32)
        for i, (c, k) in enumerate(zip(self.columns, self.centres)):
            table = ((rest[:, c][:, None] - k) ** 2).sum(axis=2).astype(np.float32)
            found += table[:, codes[:, i]]
        return np.nonzero(np.sqrt(found) <= (self.radius + error + 1e-4)[None, :])


def _unit(vec: np.ndarray) -> np.ndarray:
    vec = vec / np.abs(vec).max(axis=1, keepdims=True)  # neither overflow nor underflow
    return vec / np.linalg.norm(vec, axis=1, keepdims=True)


def _links(different: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(u, v, extra): stars that connect linked vectors, and, where v is null, links to be added to u."""
    spark = different.sparkSession
    total = different.count()
    rows = different.orderBy(F.xxhash64("vec"), "node").limit(SAMPLE).select("vec").toArrow()
    shared = spark.sparkContext.broadcast(Index.fit(_unit(matrix(rows.column("vec"), dim)), total, cosine))  # sizes are bounded above
    homes = stage(different.mapInArrow(_dealt(shared, dim), "node long, n long, vec array<double>, home int, lists array<int>"), "pq")
    # one row per list, at most LISTS
    held = {r.home: r["count"] for r in homes.groupBy("home").count().collect()}
    seen = {r.at: r["count"] for r in homes.select(F.explode("lists").alias("at")).groupBy("at").count().collect()}
    split = spark.createDataFrame([(c, -(-held[c] // MEMBERS), -(-seen.get(c, 1) // VISITORS)) for c in held],
                                  "at int, by_member int, by_visitor int") if held else None
    if split is None:
        return spark.createDataFrame([], "u long, v long, extra long")

    def numbers(count):
        return F.sequence(F.lit(0), F.col(count) - 1)

    def own(count, salt):
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(count)).cast("int")

    members = (homes.withColumn("at", F.col("home")).join(F.broadcast(split), "at")
               .select("at", own("by_member", 1).alias("m"), F.explode(numbers("by_visitor")).alias("w"),
                       F.lit(True).alias("member"), "node", "n", "vec", "home"))
    visitors = (homes.withColumn("at", F.explode("lists")).join(F.broadcast(split), "at")
                .select("at", F.explode(numbers("by_member")).alias("m"), own("by_visitor", 2).alias("w"),
                        F.lit(False).alias("member"), "node", "n", "vec", "home"))
    return (members.union(visitors).groupBy("at", "m", "w")
            .applyInArrow(_compared(shared, dim, cosine), "u long, v long, extra long"))


def _dealt(shared, dim: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                unit = _unit(matrix(some.column("vec"), dim))
                home = shared.value.home(unit)
                lists = [np.flatnonzero(v).astype(np.int32) for v in shared.value.visits(unit, home)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("node"), some.column("n"), some.column("vec").cast(pa.list_(pa.float64())),
                     pa.array(home.astype(np.int32)), pa.array(lists, pa.list_(pa.int32()))],
                    ["node", "n", "vec", "home", "lists"])
    return run


def _compared(shared, dim: int, cosine: float):
    def run(table: pa.Table) -> pa.Table:
        index = shared.value
        member = np.asarray(table.column("member").to_numpy(zero_copy_only=False), bool)
        node, n, home = (table.column(c).to_numpy() for c in ("node", "n", "home"))
        unit = _unit(matrix(table.column("vec"), dim))
        mine, come = np.flatnonzero(member), np.flatnonzero(~member)
        left, right = [], []
        if len(mine) and len(come):
            at = int(home[mine[0]])
            codes, error = index.encode(unit[mine], np.full(len(mine), at))
            for first in range(0, len(come), 128):
                some = come[first:first + 128]
                a, b = index.candidates(unit[some], at, codes, error)
                a, b = some[a], mine[b]
                other = node[a] != node[b]
                a, b = a[other], b[other]
                for i in range(0, len(a), 65536):
                    x, y = a[i:i + 65536], b[i:i + 65536]
                    near = (unit[x] * unit[y]).sum(axis=1) >= cosine
                    left.append(x[near])
                    right.append(y[near])
        if not left or not sum(map(len, left)):
            return pa.table({k: pa.array([], pa.int64()) for k in ("u", "v", "extra")})
        x, y = np.concatenate(left), np.concatenate(right)
        # a pair is found here and where the member visits; if it does not visit there, its links count here too
        members, where = np.unique(y, return_inverse=True)
        back = np.concatenate([index.visits(unit[members[i:i + 1024]], home[members[i:i + 1024]]) for i in range(0, len(members), 1024)])
        once = ~back[where, home[x]]
        extra = np.zeros(len(node), np.int64)
        np.add.at(extra, x, n[y])
        np.add.at(extra, y[once], n[x[once]])
        some = np.flatnonzero(extra)
        u, v = local_stars(node[x], node[y])
        return pa.table({"u": pa.array(np.concatenate([u, node[some]])),
                         "v": pa.array([*v.tolist(), *[None] * len(some)], pa.int64()),
                         "extra": pa.array(np.concatenate([np.zeros(len(u), np.int64), extra[some]]))})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id (the smallest vec_id
    reachable by links, itself included) and kept (vec_id = component_id).

    Linked are vectors found with a cosine of ``cosine`` or more, in double precision; none below is. Vectors
    that are null, zero or hold null or non-finite components link with nothing, and vectors of different
    lengths are not compared. Equal vectors meet once, with their number. Every row gives one row, repeated rows
    too; rows without a vec_id are linked, and named only by others. An empty table gives an empty result. Other columns, whatever their
    names, play no part.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors), "vectors")
    different = stage(rows.groupBy("vec", "dim").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
                      .withColumn("node", F.monotonically_increasing_id()), "different-vectors")
    links = spark.createDataFrame([], "u long, v long, extra long")
    for dim in lengths(different):
        links = links.union(_links(different.where(F.col("dim") == dim), dim, cosine))
    links = stage(links, "vector-links")
    found = components(links.where("v is not null").select("u", "v"))
    more = links.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("extra").alias("extra"))
    each = (different.join(found, "node", "left").join(more, "node", "left")
            .withColumn("component", F.coalesce("component", "node")))
    least = each.groupBy("component").agg(F.min("first").alias("component_id"))
    named = each.join(least, "component").select("vec", (F.col("n") - 1 + F.coalesce("extra", F.lit(0))).alias("n_links"),
                                                 "component_id")
    linked = rows.join(named, "vec").select("vec_id", "n_links", "component_id")
    alone = unusable(vectors).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
