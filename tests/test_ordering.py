"""Running values against brute force, with one key holding a third of all rows."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.features import stratified_split
from millrace.operators.ordering import blocked_row_number, blocked_running, exact_quantiles, range_running
from millrace.operators.sampling import nucleus, ranked, softmax, top_k
from millrace.operators.splits import draw_and_split, length_batches, packed


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    keys = ["hot"] * 200 + [f"k{i % 40}" for i in range(400)]
    return [(k, i, rnd.choice([0.5, 0.5, 1.0, round(rnd.random(), 3)])) for i, k in enumerate(keys)]


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_blocked_running(spark, rows, block):
    df = spark.createDataFrame(rows, "k string, i bigint, v double").withColumn("b", F.floor(F.col("i") / block))
    got = {(r.k, r.i): r for r in blocked_running(df, ["k"], [F.col("i")], ["b"], {
        "s": ("sum", F.col("v")), "m": ("max", F.col("v")), "n": ("sum", F.lit(1).cast("bigint")),
        "all": ("all_sum", F.lit(1).cast("bigint")), "low": ("all_min", F.col("v")),
    }).collect()}
    assert len(got) == len(rows)
    for key, group in by_key(rows).items():
        for n, (_, i, _) in enumerate(sorted(group, key=lambda r: r[1]), 1):
            seen = [r[2] for r in group if r[1] <= i]
            r = got[key, i]
            assert (r.n, r.m, r["all"], r.low) == (n, max(seen), len(group), min(g[2] for g in group))
            assert r.s == pytest.approx(sum(seen))


def test_without_keys(spark, rows):
    df = spark.createDataFrame(rows, "k string, i bigint, v double").withColumn("b", F.floor(F.col("i") / 11))
    got = blocked_row_number(df, [], [F.col("i")], ["b"], "n").collect()
    assert all(r.n == r.i + 1 for r in got)


def test_null_key_is_an_error(spark):
    df = spark.createDataFrame([(None, 1, 0)], "k string, i bigint, b bigint")
    with pytest.raises(PySparkException, match="null in key column k"):
        blocked_row_number(df, ["k"], [F.col("i")], ["b"], "n").collect()


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_range_running_with_ties(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, i bigint, v double")
    got = range_running(df, ["k"], [F.col("v").desc(), F.col("i")], {"n": ("sum", F.lit(1).cast("bigint"))}, parts)
    places = {(r.k, r.i): r.n for r in got.collect()}
    for key, group in by_key(rows).items():
        for n, (_, i, _) in enumerate(sorted(group, key=lambda r: (-r[2], r[1])), 1):
            assert places[key, i] == n


def test_range_running_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", 5)], "k string, i bigint")
    got = range_running(df, ["k"], [F.col("i")], {"n": ("sum", F.lit(1).cast("bigint"))}, 6).collect()
    assert sorted(r.n for r in got if r.k is None) == list(range(1, 21))


def test_quantiles(spark, rows):
    df = spark.createDataFrame(rows, "k string, i bigint, v double")
    for r in exact_quantiles(df, ["k"], "v", [0.5, 0.95]).collect():
        values = sorted(v for k, _, v in rows if k == r.k)
        for q, found in ((0.5, r.p50), (0.95, r.p95)):
            need = -(-q * len(values) // 1)
            assert found == values[int(need) - 1]


def test_split_shares(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(301)], "id bigint, y int")
    got = stratified_split(df, "y", "id", 0.25, 42)
    again = stratified_split(df.orderBy(F.rand(3)), "y", "id", 0.25, 42)
    assert got.exceptAll(again).isEmpty()
    for r in got.groupBy("y").agg(F.count("*").alias("n"), F.count(F.when(F.col("split") == "test", 1)).alias("t")).collect():
        assert r.t == round(0.25 * r.n)


def test_draw_sizes(spark):
    got = draw_and_split(spark.range(5000).withColumnRenamed("id", "k"), "k")
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {
        "training": 1050, "validation": 225, "testing": 225}
    assert got.agg(F.max("k")).first()[0] < 3000
    few = draw_and_split(spark.range(10).withColumnRenamed("id", "k"), "k")
    assert {r.split: r["count"] for r in few.groupBy("split").count().collect()} == {
        "training": 7, "validation": 1, "testing": 2}


def test_length_batches_and_packing(spark):
    lengths = [5] * 30 + list(range(1, 31))
    df = spark.createDataFrame(list(enumerate(lengths)), "id bigint, n bigint")
    batches = length_batches(df, "id", "n", 4).collect()
    assert sum(b.docs for b in batches) == 60 and max(b.docs for b in batches) == 4
    ordered = sorted(lengths)
    want = sum(max(ordered[i:i + 4]) * 4 - sum(ordered[i:i + 4]) for i in range(0, 60, 4))
    assert sum(b.padding for b in batches) == want
    start = 0
    for r in sorted(packed(df, "id", "n", 16).collect(), key=lambda r: r.id):
        n = lengths[r.id]
        assert (r.first_sequence, r.last_sequence, r["at"]) == (start // 16, (start + n - 1) // 16, start % 16)
        start += n


def test_sampling_rules(spark):
    rows = [("flat", i, 1.0) for i in range(4)] + [("peak", 0, 900.0), ("peak", 1, 1.0), ("peak", 2, -900.0)]
    df = spark.createDataFrame(rows, "c string, i bigint, s double")
    soft = softmax(df, "c", "s")
    p = {(r.c, r.i): r.p for r in soft.collect()}
    assert p["flat", 2] == pytest.approx(0.25) and p["peak", 0] == pytest.approx(1.0) and p["peak", 2] == 0.0
    kept = {(r.c, r.i): r.p for r in top_k(soft, "c", "i", 2).collect()}
    assert set(kept) == {("flat", 0), ("flat", 1), ("peak", 0), ("peak", 1)} and kept["flat", 1] == pytest.approx(0.5)
    assert top_k(soft, "c", "i", 0).count() == 7
    assert {(r.c, r.i) for r in nucleus(soft, "c", "i", 0.6).collect()} == {
        ("flat", 0), ("flat", 1), ("flat", 2), ("peak", 0)}
    assert {r.i: r["rank"] for r in ranked(df, "c", "i", "s").filter("c = 'peak'").collect()} == {0: 1, 1: 2, 2: 3}


def test_quantiles_of_a_dense_range(spark):
    """Most values lie in a millionth of the range, some are not finite, one key is null."""
    rnd = random.Random(6)
    rows = [(k, 1e-6 * rnd.random() if i % 10 else 1e9 * rnd.random()) for k in ("a", None) for i in range(500)]
    rows += [("a", float("inf")), ("a", float("nan")), ("a", None), ("b", -0.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.p25, r.p50, r.p100) for r in exact_quantiles(df, ["k"], "v", [0.25, 0.5, 1.0]).collect()}
    for k in ("a", None):
        values = sorted((v for j, v in rows if j == k and v is not None), key=lambda v: (v != v, v))
        want = [values[-(-int(len(values) * q * 100) // 100) - 1] for q in (0.25, 0.5)]
        assert list(got[k][:2]) == want
    assert got["a"][2] != got["a"][2] and got["b"] == (0.0, 0.0, 0.0) and "c" not in got
