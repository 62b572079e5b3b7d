"""Curation on the awkward rows: duplicates, nulls and the ends of every range."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from millrace.operators import curate as C, features as X
from millrace.sources.staging import fresh_path

DAY = dt.date(2024, 1, 1)
NEXT = dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def raw(spark):
    minutes = [0.0, -1.0, 29.99, 30.0, 240.0, 240.01]
    rows = [(i, 1, 10, DAY, m, "web", 0, DAY) for i, m in enumerate(minutes)]
    rows += [(10, None, 10, DAY, 5.0, "tv", 1, DAY), (11, 2, 11, NEXT, 50.0, "tv", 1, NEXT), (11, 2, 11, NEXT, 50.0, "tv", 1, NEXT)]
    schema = C.EVENT_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", dt date"
    return spark.createDataFrame(rows, schema)


def test_curate(raw):
    got = {r.event_id: r.is_long_view for r in C.curate(raw).collect()}
    assert got == {2: 0, 3: 1, 4: 1, 11: 1}


def test_any_and_smallest_keep_one_row_each(raw):
    for rule in ("any", "smallest"):
        ids = [r.event_id for r in C.one_per_event(raw, rule).collect()]
        assert sorted(ids) == sorted(set(ids)) == [0, 1, 2, 3, 4, 5, 10, 11]


def test_csv_round_trip_and_day_column(spark, raw):
    path = fresh_path(spark, "raw")
    C.write_raw(raw, path)
    back = C.read_raw(spark, path)
    assert back.schema["dt"].dataType.simpleString() == "date"
    assert back.select(*raw.columns).exceptAll(raw).isEmpty() and back.count() == raw.count()


def test_one_file_per_day_and_same_result_twice(spark, raw):
    path = fresh_path(spark, "curated")
    for _ in range(2):
        C.write_curated(C.curate(raw), path)
        files = glob.glob(f"{path}/dt=*/*.parquet")
        assert len(files) == 2
        assert spark.read.parquet(path).count() == 4
    assert C.curate_summary(spark.read.parquet(path)).first() == (4, 2, 2)


def test_a_day_beyond_the_advisory_size_becomes_several_files(spark):
    big = spark.range(40_000).select(
        F.col("id").alias("event_id"), F.sha2(F.col("id").cast("string"), 512).alias("device"), F.lit(DAY).alias("dt"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    try:
        path = fresh_path(spark, "big")
        C.write_curated(big.repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(glob.glob(f"{path}/dt=*/*.parquet")) > 1


def test_bytes_without_reading(spark, raw):
    path = fresh_path(spark, "bytes")
    C.write_raw(raw, path)
    row = C.files_and_bytes(spark, path).first()
    assert row.files == 2 and row.bytes > 100


def test_people_without_events_stay(spark, raw):
    people = spark.createDataFrame([(1, 0), (3, 1)], "subscriber_id int, y int")
    got = {r.subscriber_id: r for r in X.attach_usage(people, X.squash(raw)).collect()}
    assert set(got) == {1, 3}
    assert (got[3].minutes_30d, got[3].sessions_30d, got[3].completion_rate, got[3].distinct_titles_30d) == (0.0, 0, 0.0, 0)
    assert got[1].sessions_30d == 6


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, plan string")
    got = {r.id: (r.plan_a, r.plan_b) for r in X.one_hot(df, "plan").collect()}
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 0)}
    with pytest.raises(ValueError, match="no category"):
        X.observed_values(df, "id", at_most=2)


def test_half_even_summary(spark):
    df = spark.createDataFrame([(0, 0.25, 1), (1, 0.35, 1)], "y int, minutes_30d double, sessions_30d int")
    assert {r.y: r.minutes for r in X.group_summary(df, "y").collect()} == {0: 0.2, 1: 0.4}


def test_renumbered(spark, raw):
    ids = [r.row_id for r in C.renumbered(C.one_per_event(raw), "event_id").orderBy("dt", "event_id").collect()]
    assert ids == list(range(8))


def test_renumbered_keeps_rows_without_an_id(spark):
    rows = spark.createDataFrame([("d1", None), ("d1", 5), ("d0", 10 ** 17)], "dt string, event_id bigint")
    got = sorted((r.row_id, r.dt, r.event_id) for r in C.renumbered(rows, "event_id").collect())
    assert got == [(0, "d0", 10 ** 17), (1, "d1", None), (2, "d1", 5)]
