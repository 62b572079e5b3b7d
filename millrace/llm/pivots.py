"""Short codes for vectors, by codebooks trained with pivots (LAESA).

A vector is cut into parts, and each part is coded by the nearest entry of its position's codebook. A few pivots for
each position are chosen once, far from each other, and every part's distances to them are computed once and written
down. In each round only the entries' distances to the pivots are new: by the triangle inequality, the difference
between a part's and an entry's distance to a pivot is never above the distance between them. Entries are tried in the
order of that lower bound, by exact distances of whole numbers, until no bound is below the best distance found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.vectors import finite, floors, lengths, lists, matrix
from millrace.operators.sizing import small_side
from millrace.sources.staging import stage

#: Pivots of each position.
PIVOTS = 5
#: Vectors that are coded at a time.
AT_A_TIME = 2048
#: Distances to pivots are kept as single floats; this share of them is allowed for rounding.
ROUNDING = 1e-6


@dataclass
class Codebook:
    """The entries of one position, and its pivots, which stay as they are from round to round."""

    entries: np.ndarray
    pivots: np.ndarray

    @classmethod
    def begin(cls, entries: np.ndarray) -> Codebook:
        """Pivots are entries, each the one farthest from those chosen before."""
        chosen = [0]
        nearest = _far(entries, entries[:1])[:, 0]
        while len(chosen) < min(PIVOTS, len(entries)):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _far(entries, entries[chosen[-1:]])[:, 0])
        return cls(entries, entries[chosen])

    def distances(self, parts: np.ndarray) -> np.ndarray:
        return _far(parts, self.pivots)

    def nearest(self, parts: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) for each part, ties to the smaller entry, and how many exact distances it took."""
        own = self.distances(self.entries)
        bound = np.abs(far[:, None, :] - own[None, :, :]).max(axis=2, initial=0)
        slack = ROUNDING * (far.max(axis=1, initial=0) + own.max(initial=0)) + ROUNDING
        order = np.argsort(bound, axis=1, kind="stable")
        code = np.full(len(parts), len(self.entries))
        best = np.full(len(parts), np.iinfo(np.int64).max)
        open_, taken = np.arange(len(parts)), 0
        for place in range(len(self.entries)):
            entry = order[open_, place]
            still = bound[open_, entry] - slack[open_] <= np.sqrt(best[open_].astype(np.float64))
            open_, entry = open_[still], entry[still]
            if not len(open_):
                break
            taken += len(open_)
            square = ((parts[open_] - self.entries[entry]) ** 2).sum(axis=1)
            better = (square < best[open_]) | (square == best[open_]) & (entry < code[open_])
            best[open_[better]], code[open_[better]] = square[better], entry[better]
        return code, best, taken


def _far(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(((points[:, None, :] - others[None, :, :]) ** 2).sum(axis=2).astype(np.float64))


def cuts(dim: int, parts: int) -> list[slice]:
    """Consecutive parts, equal in length; if the length does not divide, the first ones are one longer."""
    ends = np.cumsum([0] + [dim // parts + (i < dim % parts) for i in range(parts)])
    return [slice(a, b) for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _measured(books: list[Codebook], where: list[slice], scale: int):
    """Adds the vector in whole numbers and all its parts' distances to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_A_TIME):
                some = batch.slice(at, AT_A_TIME)
                whole = floors(matrix(some.column("vec"), where[-1].stop), scale)
                far = np.concatenate([b.distances(whole[:, c]) for b, c in zip(books, where)], axis=1)
                yield pa.RecordBatch.from_arrays([some.column("vec_id"), some.column("label"), lists(whole.astype(np.int32)),
                                                  lists(far.astype(np.float32))], ["vec_id", "label", "whole", "far"])
    return run


def _coded(batch: pa.RecordBatch, books: list[Codebook], where: list[slice]) -> Iterator[tuple]:
    """(rows, their vectors, codes by position, squared distances by position), some rows at a time."""
    dim, wide = where[-1].stop, len(books[0].pivots)
    for at in range(0, batch.num_rows, AT_A_TIME):
        some = batch.slice(at, AT_A_TIME)
        whole = np.asarray(some.column("whole").flatten()).reshape(len(some), dim).astype(np.int64)
        far = matrix(some.column("far"), wide * len(books)).reshape(len(some), len(books), wide)
        found = [b.nearest(whole[:, c], far[:, i]) for i, (b, c) in enumerate(zip(books, where))]
        yield some, whole, np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)


def _sums(books: list[Codebook], where: list[slice]):
    """One row per position, entry in use and task: how many parts, and their components' sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(books), len(books[0].entries)), np.int64)
        total = np.zeros((*n.shape, max(c.stop - c.start for c in where)), np.int64)
        for batch in batches:
            for _, whole, codes, _ in _coded(batch, books, where):
                for i, c in enumerate(where):
                    n[i] += np.bincount(codes[:, i], minlength=n.shape[1])
                    np.add.at(total[i, :, :c.stop - c.start], codes[:, i], whole[:, c])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
                                          pa.array(n[part, entry]), lists(total[part, entry])], ["part", "entry", "n", "total"])
    return run


def _final(books: list[Codebook], where: list[slice]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, _, codes, square in _coded(batch, books, where):
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), pa.array([r.tobytes().hex() for r in codes.astype(np.uint8)]),
                     pa.array(square.sum(axis=1))], ["vec_id", "label", "code", "error"])
    return run


def train(rows: DataFrame, dim: int, parts: int = 16, entries: int = 64, rounds: int = 2,
          scale: int = 256) -> tuple[list[Codebook], DataFrame]:
    """The codebooks after all rounds, and the staged ``rows`` (vec_id, label, vec) with their distances to the pivots.

    A round brings one row of sums per position and entry to the driver.
    """
    first = rows.select("vec_id", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    whole = floors(np.array([r.vec for r in first], np.float64).reshape(len(first), dim), scale)
    where = cuts(dim, parts)
    books = [Codebook.begin(whole[:, c]) for c in where]
    label = next(f.dataType for f in rows.schema if f.name == "label")
    kept = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label),
                         T.StructField("whole", T.ArrayType(T.IntegerType())), T.StructField("far", T.ArrayType(T.FloatType()))])
    measured = stage(rows.mapInArrow(_measured(books, where, scale), kept), "pivots")
    wide = max(c.stop - c.start for c in where)
    for _ in range(rounds):
        sums = measured.mapInArrow(_sums(books, where), "part int, entry int, n long, total array<long>")
        each = [F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(wide)]
        moved = [b.entries.copy() for b in books]
        for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():
            moved[r.part][r.entry] = [r[f"c{i}"] // r.n for i in range(moved[r.part].shape[1])]
        books = [Codebook(m, b.pivots) for m, b in zip(moved, books)]
    return books, measured


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
             label: str = "label") -> DataFrame:
    """One row per vector: vec_id, code (the entry of each part, two hex digits each), error (squared distances summed
    over the parts), label_error (error summed over equal labels, nulls together), codebooks_sha256.

    A component x counts as floor(scale * x). Codebooks start with the parts of the ``entries`` smallest vec_ids; each round
    gives every part to its nearest entry, ties to the smaller one, and moves the entries in use to the floor of
    their parts' mean; then the parts are assigned once more.

    Rows whose vector is null or holds null or non-finite components give no row. Repeated rows count, and give a row, each
    time; they also take an entry each. Rows without a vec_id come last; rows with one vec_id are taken in the order
    of their values. Vectors of different lengths have codebooks of their own; where a length does not divide
    into equal parts, the first ones are one component longer, and parts without components have distance 0 and
    code 0. Components whose squared distances would not fit 64 bits are an error. ``entries`` is at most 256. Other columns,
    whatever their names, play no part. An empty table gives an empty result.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = finite(vectors, F.col(label).alias("label"))
    coded = []
    for dim in lengths(rows):
        books, measured = train(rows.where(F.col("dim") == dim).select("vec_id", "label", "vec"), dim, parts, entries, rounds, scale)
        kind = T.StructType([*measured.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        text = ",".join(str(x) for b in books for x in b.entries.ravel().tolist())
        coded.append(measured.mapInArrow(_final(books, cuts(dim, parts)), kind)
                     .withColumn("codebooks_sha256", F.lit(hashlib.sha256(text.encode()).hexdigest())))
    if not coded:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    each = coded[0]
    for more in coded[1:]:
        each = each.union(more)
    each = stage(each, "codes")
    by_label = stage(each.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    by_label = small_side(by_label.withColumnRenamed("label", "of"))
    return (each.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))
