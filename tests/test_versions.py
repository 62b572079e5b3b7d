"""Table sets in versions: what readers see before, during and after a new one."""

import pytest
from pyspark.sql import functions as F

from millrace.sources import catalog as K
from millrace.sources.staging import fresh_path
from millrace.sources.versions import TableSet


@pytest.fixture
def wanted(spark):
    return spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "table_name string, expected bigint")


def rows(tables):
    return {name: df.count() for name, df in tables.items()}


def test_rebuilds_what_fails_and_then_nothing(spark, wanted):
    folder = fresh_path(spark, "set")
    first = TableSet(spark, folder)
    assert first.current() == (0, {}) and first.tables() == {}
    first.publish({"a": spark.range(3), "b": spark.range(9)})
    kept, calls = first.current()[1]["a"], []

    def rebuild(names):
        calls.append(names)
        return {n: spark.range({"b": 2, "c": 1}[n]) for n in names}
    assert first.ensure(wanted, rebuild) == ["b", "c"] == calls[0]
    number, paths = first.current()
    assert number == 2 and paths["a"] == kept and K.all_ok(first.check(wanted))
    assert first.ensure(wanted, rebuild) == [] and len(calls) == 1 and first.current()[0] == 2


def test_other_sessions_see_the_new_version_and_old_readers_keep_theirs(spark, wanted):
    folder = fresh_path(spark, "set")
    TableSet(spark, folder).publish({"a": spark.range(1)})
    other = TableSet(spark.newSession(), folder)
    before = other.tables()["a"]
    assert before.count() == 1
    TableSet(spark, folder).ensure(wanted, lambda names: {n: spark.range({"a": 3, "b": 2, "c": 1}[n]) for n in names})
    assert before.count() == 1 and rows(other.tables()) == {"a": 3, "b": 2, "c": 1}


def test_a_crash_before_the_pointer_moves_leaves_the_old_version(spark, wanted, monkeypatch):
    folder = fresh_path(spark, "set")
    one = TableSet(spark, folder)
    one.publish({"a": spark.range(1)})
    before = one.current()

    def crash(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(TableSet, "publish", crash)
    with pytest.raises(KeyboardInterrupt):
        one.ensure(wanted, lambda names: {n: spark.range({"a": 3, "b": 2, "c": 1}[n]) for n in names})
    monkeypatch.undo()
    assert TableSet(spark, folder).current() == before and rows(one.tables()) == {"a": 1}

    def broken(names):
        return {n: spark.range(3).select(F.raise_error(F.lit("no source")).alias("id")) for n in names}
    with pytest.raises(Exception, match="no source"):
        one.ensure(wanted, broken)
    with pytest.raises(ValueError, match="fail their check"):
        one.ensure(wanted, lambda names: {n: spark.range(7) for n in names})
    assert TableSet(spark, folder).current() == before


def test_lost_files_count_as_missing(spark, wanted):
    one = TableSet(spark, fresh_path(spark, "set"))
    one.publish({"a": spark.range(3), "b": fresh_path(spark, "gone"), "c": spark.range(1)})
    assert {r.table_name: r.status for r in one.check(wanted).collect()} == {"a": "ok", "b": "MISSING", "c": "ok"}
    assert one.ensure(wanted, lambda names: {n: spark.range(2) for n in names}) == ["b"]


def test_dropped_tables(spark):
    one = TableSet(spark, fresh_path(spark, "set"))
    one.publish({"a": spark.range(3), "b": spark.range(1)})
    one.publish({}, dropped=("a",))
    assert rows(one.tables()) == {"b": 1} and one.current()[0] == 2


def test_described(spark):
    df = spark.createDataFrame([(2, "x" * 50, [1.0]), (1, None, [1.0, 2.0]), (3, "z", None), (9, "never", None)], "k int, t string, v array<double>")
    got = sorted(tuple(r) for r in K.described("t", df, ["k"], 3, 4).collect())
    assert got == [("t", 1, "k", "int", 4, "1 | 2 | 3"), ("t", 2, "t", "string", 3, "NULL | xxxx | z"),
                   ("t", 3, "v", "array<double>", 2, "2 values | 1 values | NULL")]
    assert [r.sample for r in K.described("t", df.limit(0), ["k"]).collect()] == [None] * 3
