"""Raw watch events to clean, day-partitioned Parquet."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.ordering import range_running
from millrace.sources.staging import write_by

# The columns of the raw files and the limits of a valid session.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("subscriber_id", T.IntegerType()),
    T.StructField("content_id", T.IntegerType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("watch_minutes", T.DoubleType()),
    T.StructField("device", T.StringType()),
    T.StructField("completed", T.IntegerType()),
])

LONGEST_SESSION = 240
LONG_VIEW = 30


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Daily CSV folders with a declared schema; ``dt`` comes from the folder names."""
    return spark.read.option("header", True).schema(EVENT_SCHEMA).csv(path)


def write_raw(events: DataFrame, path: str) -> None:
    """The same layout as a sink: one ``dt=`` folder per day, CSV with a header line."""
    write_by(events, "dt", path, "csv", header=True)


def one_per_event(events: DataFrame, survivor: str = "any") -> DataFrame:
    """One row per ``event_id``.

    ``any`` keeps whichever copy arrives first; ``smallest`` keeps the lowest row in column
    order, so that a second engine can name the same one. Both combine copies before the shuffle,
    so an event copied a billion times costs one row per input task.
    """
    if survivor == "any":
        return events.dropDuplicates(["event_id"])
    rest = [c for c in events.columns if c != "event_id"]
    return (
        events.groupBy("event_id").agg(F.min(F.struct(*rest)).alias("_row"))
        .select("event_id", *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*events.columns)
    )


def valid_events(events: DataFrame) -> DataFrame:
    minutes = F.col("watch_minutes")
    return events.filter(F.col("subscriber_id").isNotNull()).filter((minutes > 0) & (minutes <= LONGEST_SESSION))


def long_view_flag(events: DataFrame) -> DataFrame:
    return events.withColumn("is_long_view", (F.col("watch_minutes") >= LONG_VIEW).cast("int"))


def curate(raw: DataFrame, survivor: str = "any") -> DataFrame:
    """Duplicates go first, then bad rows, as the order decides which copy may survive."""
    return long_view_flag(valid_events(one_per_event(raw, survivor)))


def write_curated(clean: DataFrame, path: str) -> None:
    """One folder per day; a usual day becomes one file, a day beyond the advisory size several."""
    write_by(clean, "dt", path)


def curate_summary(written: DataFrame) -> DataFrame:
    """Rows, subscribers and days of the written table.

    Days and rows come from the folder column; only the subscriber column is read and counted
    per value, so no row is expanded into one copy per distinct count.
    """
    per_day = written.groupBy("dt").agg(F.count("*").alias("n"))
    subscribers = written.select("subscriber_id").distinct().agg(F.count("subscriber_id").alias("subscribers"))
    return per_day.agg(F.sum("n").alias("rows"), F.count("dt").alias("days")).select(
        "rows", subscribers.scalar().alias("subscribers"), "days"
    )


def distinct_counts(events: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return events.agg(count("subscriber_id").alias("subscribers"), count("dt").alias("days"))


def recent_days(events: DataFrame, cutoff: date | str) -> DataFrame:
    """Days on or after the cutoff; on a ``dt`` partitioned table other folders are never opened."""
    return events.filter(F.col("dt") >= F.lit(str(cutoff)).cast("date"))


def files_and_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Size of a folder of files without reading their contents."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "length").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def union_daily(days: list[DataFrame]) -> DataFrame:
    """Frames of single days stacked by column name."""
    out = days[0]
    for day in days[1:]:
        out = out.unionByName(day)
    return out


def renumbered(events: DataFrame, key: str) -> DataFrame:
    """Adds ``row_id``: 0, 1, 2, ... over all days, by day and key, counted in range pieces; no day or key comes first."""
    one = F.lit(1).cast("bigint")
    numbered = range_running(events, [], [F.col("dt"), F.col(key)], {"_n": ("sum", one)})
    return numbered.withColumn("row_id", F.col("_n") - 1).drop("_n")
