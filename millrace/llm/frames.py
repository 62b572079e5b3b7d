"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.operators.sizing import spread
from millrace.sources.staging import stage

#: Bytes of text that are worked on at a time.
BYTES = 1 << 20
#: Spark's setting for the number of pieces that files are cut into at least.
PIECES = "spark.sql.files.minPartitionNum"


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text, plus the named columns. Other columns of ``docs`` play no part."""
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                              *more))


def by_slices(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = 512, text: int | None = None):
    """A function for ``mapInArrow`` that hands ``work`` a bounded number of rows at a time, and of bytes where the
    place of a ``text`` column is given (one row at least)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, rows, text):
                out = work(some)
                if out is not None:
                    yield out
    return run


def slices(batch: pa.RecordBatch, rows: int, text: int | None = None) -> Iterator[pa.RecordBatch]:
    size = None if text is None else pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
    at = 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at)
        if size is not None:
            n = max(1, int(np.searchsorted(np.cumsum(size[at:at + n], dtype=np.int64), BYTES, side="right")))
        yield batch.slice(at, n)
        at += n


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes, null as no bytes."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def numbered(docs: DataFrame, scan: bool, *more: str) -> DataFrame:
    """``documents`` with a number for every row, which all readers of the result see alike.

    A plain scan of files (``scan``) has its rows in the same place each time, so the numbers need not be written
    down. Anything else, and a scan that is dealt out to more cores, is. How a scan is cut depends on the cores Spark knows of, which
    may come and go: their number as first seen is held in the session's setting for it, so that later scans are cut alike.
    """
    spark = docs.sparkSession
    if spark.conf.get(PIECES, None) is None:
        spark.conf.set(PIECES, str(spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism))
    rows = documents(docs, *more).withColumn("row", F.monotonically_increasing_id())
    stable = scan and docs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    return rows if stable else stage(rows, "numbered")
