"""A document store in buckets of ids, of which a change writes only those it touches.

Documents lie in buckets by a hash of their id. A version of the store is a list of bucket files (see ``sources.versions``);
adding, updating or deleting reads and writes the buckets of the ids concerned, and the new version names the
others' files as before. Readers of an older version keep their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators import stores as St
from millrace.operators.sizing import _bytes_of, small_side
from millrace.sources.staging import stage, write_by
from millrace.sources.versions import TableSet

BUCKET = "_bucket"
#: Bytes of documents that one task writes, about. A bucket of more is written by several, each a share by the hash of the ids.
SHARE = 32 << 20


class BucketStore:
    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int = 64):
        """``schema`` has one column ``key``, unique in the store. The number of buckets stays as it was at first."""
        self.set, self.schema, self.key, self.buckets = TableSet(spark, folder), schema, key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def files(self) -> dict[str, str]:
        """Where each bucket of the version in force is."""
        return self.set.current()[1]

    def read(self, only: set[str] | None = None) -> DataFrame:
        """All documents of the version in force, or those of some buckets."""
        paths = [path for bucket, path in sorted(self.files().items()) if only is None or bucket in only]
        if not paths:
            return self.set.spark.createDataFrame([], self.schema)
        return self.set.spark.read.schema(self.schema).parquet(*paths)

    def _shares(self, rows: DataFrame) -> int:
        """How many tasks a bucket's share of these rows is for."""
        each = reduce(Column.__add__, [_bytes_of(f) for f in self.schema.fields])
        return -(-(rows.agg(F.sum(each)).first()[0] or 0) // (self.buckets * SHARE))

    def _write(self, rows: DataFrame, touched: set[str], measured: DataFrame) -> int:
        """``measured`` (stored or staged) is about as large as the rows."""
        path = f"{self.set.folder}/data-{uuid.uuid4().hex}"
        shares, named = self._shares(measured), rows.select(*self.schema.names, self._bucket())
        if shares > 1:
            share = F.pmod(F.xxhash64(F.lit(1), F.col(self.key).cast("string")), F.lit(shares))
            named.repartition(self.buckets * shares, F.col(BUCKET), share).write.partitionBy(BUCKET).parquet(path)
        else:
            write_by(named, BUCKET, path)
        held = self.set.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
        written = {str(r[0]) for r in held.select(BUCKET).distinct().collect()}  # at most ``buckets``
        return self.set.publish({b: f"{path}/{BUCKET}={b}" for b in written}, tuple(touched - written))

    def create(self, documents: DataFrame) -> int:
        return self._write(documents, set(self.files()), documents)

    def _change(self, given: DataFrame, merge: Callable[[DataFrame, DataFrame, str], DataFrame]) -> int:
        given = stage(given, "changes")
        touched = {str(r[0]) for r in given.select(self._bucket()).distinct().collect()}
        if not touched:
            return self.set.current()[0]
        held = self.read(touched)
        return self._write(merge(held, small_side(given), self.key), touched, held)

    def add(self, documents: DataFrame) -> int:
        """New documents, with unique ids; one that is there already is replaced."""
        return self._change(documents.select(*self.schema.names), St.add_documents)

    def update(self, changes: DataFrame) -> int:
        """Replaces the columns that a change names (non-null) of documents that are there."""
        return self._change(changes, St.update_documents)

    def delete(self, ids: DataFrame) -> int:
        return self._change(ids.select(self.key), St.delete_documents)

    def get(self, ids: DataFrame) -> DataFrame:
        """Documents by id, from their buckets only; ids nobody stored give nothing."""
        wanted = stage(ids.select(self.key), "wanted")
        touched = {str(r[0]) for r in wanted.select(self._bucket()).distinct().collect()}
        return St.get_documents(self.read(touched), small_side(wanted), self.key)
