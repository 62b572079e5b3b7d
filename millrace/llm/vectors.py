"""What the vector operators share: which rows take part, and arrays out of Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def _split(vectors: DataFrame, sound: bool) -> DataFrame:
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
            .where(good if sound else ~good).withColumn("dim", F.size("vec")))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, dim): rows whose embedding is there, holds finite numbers only, and is not all zero."""
    return _split(vectors, True)


def unusable(vectors: DataFrame) -> DataFrame:
    """All other rows."""
    return _split(vectors, False)


def lengths(usable_vectors: DataFrame) -> list[int]:
    """The lengths that occur; vectors of different lengths are never compared."""
    return sorted(r.dim for r in usable_vectors.select("dim").distinct().collect())


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A column of lists of ``dim`` numbers as an array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), dim).astype(np.float64)


def finite(vectors: DataFrame, *more: str | Column) -> DataFrame:
    """(vec_id, vec, dim) and the named columns: rows whose embedding is there and holds finite numbers only."""
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), *more)
            .where(F.coalesce(F.col("vec").isNotNull() & sound, F.lit(False))).withColumn("dim", F.size("vec")))


def floors(vec: np.ndarray, scale: int) -> np.ndarray:
    """Each component as the whole number floor(scale * x); an error where squared distances might not fit 64 bits."""
    whole = np.floor(scale * vec)
    limit = min(2.0 ** 30, (2.0 ** 63 / max(1, vec.shape[1])) ** 0.5 / 2)
    if whole.size and max(-whole.min(), whole.max()) >= limit:
        raise ValueError(f"a component of {np.abs(vec).max()} is too large: its squared distances would not fit 64 bits")
    return whole.astype(np.int64)


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as a column of lists."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel()))
