"""A store in buckets: what a change writes, and what it leaves."""

import random

from millrace.operators.buckets import BucketStore
from millrace.sources.staging import fresh_path

SCHEMA = "id string, text string, source string"


def test_against_a_dictionary(spark):
    rng = random.Random(5)
    held = {f"d{i}": (f"text {i}", "tweet") for i in range(60)}
    first = spark.createDataFrame([(k, *v) for k, v in held.items()], SCHEMA)
    store = BucketStore(spark, fresh_path(spark, "store"), first.schema, "id", 8)
    assert store.read().count() == 0
    store.create(first)

    def same():
        got = store.read().collect()
        assert len(got) == len(held) and {r.id: (r.text, r.source) for r in got} == held
    same()
    for step in range(3):
        before = store.files()
        new = {f"d{rng.randrange(90)}": (f"new {step}", "news") for _ in range(3)}
        store.add(spark.createDataFrame([(k, *v) for k, v in new.items()], SCHEMA))
        held |= new
        same()
        change = {f"d{rng.randrange(120)}": f"changed {step}" for _ in range(2)}
        store.update(spark.createDataFrame([(k, v, None) for k, v in change.items()], SCHEMA))
        held |= {k: (v, held[k][1]) for k, v in change.items() if k in held}
        same()
        gone = [f"d{rng.randrange(60)}" for _ in range(2)]
        store.delete(spark.createDataFrame([(k,) for k in gone], "id string"))
        held = {k: v for k, v in held.items() if k not in gone}
        same()
        assert before.keys() >= store.files().keys() or len(held) > 0


def test_only_touched_buckets_are_written(spark):
    first = spark.createDataFrame([(str(i), "t", "s") for i in range(100)], SCHEMA)
    store = BucketStore(spark, fresh_path(spark, "store"), first.schema, "id", 8)
    store.create(first)
    before, old = store.files(), store.read()
    assert len(before) == 8
    store.update(spark.createDataFrame([("7", "new", None)], SCHEMA))
    after = store.files()
    assert sum(before[b] != after[b] for b in before) == 1 and old.filter("text = 'new'").count() == 0
    assert [r.text for r in store.get(spark.createDataFrame([("7",), ("none",)], "id string")).collect()] == ["new"]
    number = store.set.current()[0]
    assert store.update(spark.createDataFrame([], SCHEMA)) == number and store.files() == after


def test_emptied_buckets_go(spark):
    first = spark.createDataFrame([("a", "t", "s"), ("b", "t", "s"), (None, "t", "s")], SCHEMA)
    store = BucketStore(spark, fresh_path(spark, "store"), first.schema, "id", 4)
    store.create(first)
    assert store.read().count() == 3
    store.delete(spark.createDataFrame([("a",), ("b",)], "id string"))
    assert [r.id for r in store.read().collect()] == [None]
    alone = BucketStore(spark, fresh_path(spark, "store"), first.schema, "id", 1)
    alone.create(first.limit(1))
    alone.delete(first.select("id"))
    assert alone.read().count() == 0 and alone.files() == {}


def test_a_large_bucket_is_written_by_several_tasks(spark, monkeypatch):
    from pathlib import Path

    from millrace.operators import buckets

    monkeypatch.setattr(buckets, "SHARE", 2000, raising=False)
    rows = [(f"d{i}", f"text {i} " * 20, "tweet") for i in range(200)]
    store = BucketStore(spark, fresh_path(spark, "store"), spark.createDataFrame(rows, SCHEMA).schema, "id", 2)
    store.create(spark.createDataFrame(rows, SCHEMA))
    store.update(spark.createDataFrame([("d7", None, "news"), ("zz", None, "news")], SCHEMA))
    assert sorted(map(tuple, store.read().collect())) == sorted([(k, t, "news" if k == "d7" else s) for k, t, s in rows])
    assert all(len(list(Path(path).glob("*.parquet"))) > 3 for path in store.files().values())
