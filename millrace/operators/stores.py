"""Document and vector stores as tables: add, update, delete, fetch, compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.sources.staging import fresh_path, write_by


def text_id(text: Column) -> Column:
    """The id generated for a document that comes without one; the same text gets the same id."""
    return F.md5(text)


def newest(versions: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key, the highest version. Copies shrink before the shuffle."""
    rest = [c for c in versions.columns if c not in (key, version)]
    return (
        versions.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in [version, *rest]])
        .select(*versions.columns)
    )


def add_documents(store: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """The store plus new documents; a key already there is replaced. ``added`` has unique keys."""
    return store.join(added.select(key), key, "left_anti").select(*store.columns).unionByName(added)


def update_documents(store: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Replaces the columns that a change names (non-null) and leaves the rest of the store alone."""
    fields = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields])
    return store.join(renamed, key, "left").select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in store.columns]
    )


def delete_documents(store: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return store.join(ids.select(key), key, "left_anti")


def get_documents(store: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Stored documents by id; ids nobody stored give nothing."""
    return store.join(ids.select(key), key, "left_semi")


def save_store(store: DataFrame, name: str, collection: str = "collection") -> str:
    """A new version of the store on disk, one folder per collection; returns its path."""
    path = fresh_path(store.sparkSession, name)
    write_by(store, collection, path)
    return path


def compare_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """(rows_left, rows_right, only_left, only_right, same_schema), counting repeated rows.

    Both tables are stacked with +1 and -1 and summed per distinct row: one shuffle, and copies
    of a row are summed before it.
    """
    same_schema = [(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema]
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {columns} and {right.columns}")
    sides = left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(
        right.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    )
    per_row = sides.groupBy(*columns).agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    return per_row.agg(
        F.sum("l").alias("rows_left"), F.sum("r").alias("rows_right"),
        F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))).alias("only_left"),
        F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))).alias("only_right"),
    ).withColumn("same_schema", F.lit(same_schema))


