"""JSON-lines splits and the match between files and their registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.staging import write_by


def write_lines(rows: DataFrame, path: str) -> None:
    """(split, value) as one line per row in a folder per split, all splits in one pass."""
    write_by(rows, "split", path, "text")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, split string").text(path)


def integrity(files: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """(key, status): files nobody registered are orphans, registrations without a file dangle."""
    have = files.select(key).distinct().withColumn("_file", F.lit(True))
    know = registered.select(key).distinct().withColumn("_entry", F.lit(True))
    both = have.join(know, key, "full")
    return both.filter("_file is null or _entry is null").select(
        key, F.when(F.col("_entry").isNull(), "orphan").otherwise("dangling").alias("status")
    )
