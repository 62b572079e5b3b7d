"""Reading, checking and rebuilding."""


import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import stores as St
from millrace.operators.star import approximate_profile
from millrace.sources import catalog as K, readers as R, sinks
from millrace.sources.staging import fresh_path, shared_dir, stage


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


@pytest.mark.parametrize("raw,text", [
    ("é".encode(), "é"), (b"\xef\xbb\xbfabc", "abc"), ("é".encode("latin-1"), "é"), (b"", ""), (b"\xff\xfe", "ÿþ"), ("日本".encode(), "日本"),
])
def test_decode(spark, raw, text):
    df = spark.createDataFrame([(bytearray(raw),)], "c binary")
    assert df.select(R.decoded_text(F.col("c"))).first()[0] == text


def test_files(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(bytes(range(256)) * 3)
    row = R.binary_files(spark, str(tmp_path), "image/jpeg").first()
    import base64
    assert row.uri == "data:image/jpeg;base64," + base64.b64encode(bytes(range(256)) * 3).decode()
    (tmp_path / "a.jpg").unlink()
    (tmp_path / "t.txt").write_bytes("ü".encode("latin-1"))
    assert R.text_files(spark, str(tmp_path)).first().text == "ü"


def test_pages_from_an_extractor(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    (tmp_path / "b.pdf").write_bytes(b"")
    pages = R.document_pages(spark, str(tmp_path), lambda content: content.decode().split("|") if content else [])
    assert sorted((r.source[-5:], r.page, r.text) for r in pages.collect()) == [("a.pdf", 1, "one"), ("a.pdf", 2, "two")]
    joined = R.joined_pages(pages, "source").first()
    assert (joined.pages, joined.text) == (2, "onetwo")


def test_fallback_only_when_there_is_no_access(spark):
    mirror = fresh_path(spark, "mirror")
    spark.range(3).write.json(mirror)
    missing = fresh_path(spark, "missing")
    assert R.first_readable_json(spark, [missing, mirror], "id bigint").count() == 3
    with pytest.raises(AnalysisException):
        R.first_readable_json(spark, [missing, missing + "x"], "id bigint")
    with pytest.raises(Exception, match="(?i)schema|parse|syntax|datatype"):
        R.first_readable_json(spark, [mirror, mirror], "id not_a_type")


def test_jdbc_query_text():
    class Fake:
        class read:
            @staticmethod
            def jdbc(url, table, **options):
                return url, table, options
    url, table, options = R.jdbc_reader(Fake, "jdbc:x", "subscribers", "subscriber_id", 0, 100, 8)(["a", "b"])
    assert table == "(select a, b from subscribers) t" and options["numPartitions"] == 8 and options["column"] == "subscriber_id"


def test_counts_and_rebuild(spark):
    expected = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "table_name string, expected bigint")
    counts = K.row_counts({"a": spark.range(3), "b": spark.range(5)})
    got = {r.table_name: r.status for r in K.check_counts(counts, expected).collect()}
    assert got == {"a": "ok", "b": "MISMATCH", "c": "MISSING"}
    good = {"a": spark.range(3), "b": spark.range(2), "c": spark.range(1)}
    calls = []
    tables, rebuilt = K.ensure_tables({"a": spark.range(3)}, expected, lambda: calls.append(1) or good)
    assert rebuilt and calls == [1] and K.all_ok(K.check_counts(K.row_counts(tables), expected))
    tables, rebuilt = K.ensure_tables(tables, expected, lambda: calls.append(2) or good)
    assert not rebuilt and calls == [1]
    with pytest.raises(ValueError, match="fail their check"):
        K.ensure_tables({}, expected, lambda: {**good, "c": spark.range(9)})


def test_catalog(spark):
    spark.range(2).createOrReplaceTempView("known_table")
    assert "known_table" in K.table_names(spark, ["known_table"])
    with pytest.raises(LookupError, match="unknown_table"):
        K.table_names(spark, ["unknown_table"])
    info = K.table_info("t", spark.createDataFrame([(1, None), (2, "x")], "a int, b string")).collect()
    assert [tuple(r) for r in info] == [("t", 1, "a", "int", 2), ("t", 2, "b", "string", 1)]
    assert [r.id for r in K.sample_rows(spark.range(100).orderBy(F.rand(1)), "id").collect()] == [0, 1, 2]


def test_integrity(spark):
    have = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    know = spark.createDataFrame([(2,), (3,)], "k int")
    assert {tuple(r) for r in sinks.integrity(have, know, "k").collect()} == {(1, "orphan"), (3, "dangling")}


def test_stores(spark):
    store = spark.createDataFrame([("1", "a", "tweet"), ("2", "b", "news")], "id string, text string, source string")
    added = spark.createDataFrame([("2", "B", "news"), ("3", "c", "web")], "id string, text string, source string")
    assert {tuple(r) for r in St.add_documents(store, added, "id").collect()} == {
        ("1", "a", "tweet"), ("2", "B", "news"), ("3", "c", "web")}
    change = spark.createDataFrame([("1", "A", None)], "id string, text string, source string")
    assert {tuple(r) for r in St.update_documents(store, change, "id").collect()} == {("1", "A", "tweet"), ("2", "b", "news")}
    ids = spark.createDataFrame([("2",), ("9",)], "id string")
    assert [r.id for r in St.delete_documents(store, ids, "id").collect()] == ["1"]
    assert [r.id for r in St.get_documents(store, ids, "id").collect()] == ["2"]
    versions = spark.createDataFrame([("1", 1, "old"), ("1", 2, "new")], "id string, v int, text string")
    assert [r.text for r in St.newest(versions, "id", "v").collect()] == ["new"]


def test_compare_tables_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a int")
    assert St.compare_tables(left, right).first() == (4, 4, 1, 1, True)
    assert St.compare_tables(left, left.select(F.col("a").cast("long"))).first().same_schema is False


def test_approximate_profile(spark, sf):
    rows = {r.column_name: r for r in approximate_profile(spark.read.parquet(f"{sf}/events.parquet")).collect()}
    assert rows["event_id"].rows == rows["ts"].rows and rows["event_type"].distinct_values == 5


def test_staged_table_is_stable(spark):
    df = stage(spark.range(50).withColumn("r", F.rand()), "stable")
    assert df.exceptAll(df).isEmpty()
