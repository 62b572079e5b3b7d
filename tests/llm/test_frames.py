from pyspark.sql import functions as F

from millrace.llm import frames, langid


def test_numbers_do_not_depend_on_the_cores_of_the_moment(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(400_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).coalesce(2).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in (frames.PIECES, "spark.sql.leafNodeDefaultParallelism")}
    try:
        spark.conf.unset(frames.PIECES)
        # fewer cores than pieces, so that the scan is read as it lies
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "8")
        one = frames.numbered(spark.read.parquet(path), True)
        first = {(r.row, r.doc_id) for r in one.select("row", "doc_id").sample(0.01, 1).collect()}
        for cores in ("3", "64"):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
            again = frames.numbered(spark.read.parquet(path), True)
            both = one.select("row", "doc_id").join(again.select("row", F.col("doc_id").alias("other")), "row", "full")
            assert both.where("not (doc_id <=> other)").isEmpty()
        assert len(first) > 100
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_languages_are_learnt_from_rows_without_ids(spark):
    """All rows without a doc_id are not one row: the sample has some of every language."""
    words = {"en": ["the", "house", "with", "thinking"], "de": ["das", "haus", "mit", "denken"]}
    rows = [(None, " ".join(words[lang][(i + j * 3) % 4] for j in range(12)) + f" {i}", lang) for lang, n in (("en", 4000), ("de", 40)) for i in range(n)]
    found = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ["lang"]).groupBy("lang", "lang_pred").count().collect()
    right = sum(r["count"] for r in found if r.lang == r.lang_pred)
    assert right > 0.99 * len(rows)


def test_rare_scripts_keep_their_letters():
    """Letters of all scripts are told apart, however many others there are."""
    import numpy as np

    many = {chr(0x4E00 + i): 10_000 for i in range(5000)} | {chr(0x10D0 + i): 1 for i in range(30)} | {chr(0x561 + i): 1 for i in range(30)}
    code = langid.alphabet_of(many)
    known = code[[ord(x) for x in many]]
    assert len(np.unique(known)) == len(many) and langid.OTHER not in known
