import zlib

import numpy as np

from millrace.llm import langid


def test_models_sum_to_one():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcde "), 200, p=[.3, .2, .2, .1, .1, .1])) for _ in range(8)]
    code = langid.alphabet_of({x: 1 for x in "abcde"})
    parts = []
    for lang in (0, 1):
        s, first = langid.symbols(texts[lang::2], code)
        parts.append((np.full(len(s), lang), langid.grams(s, first)))
    keys, n = np.unique(np.concatenate([np.stack([a.astype(np.uint64), b]) for a, b in parts], axis=1), axis=1, return_counts=True)
    model = langid.Model.fit(["x", "y"], code, keys[0].astype(np.int64), keys[1], n)
    for context in (0, int(keys[1][5]) >> langid.BITS, 7 << 20 | 3 << 10 | 9):
        all_next = np.array([context << langid.BITS | x for x in range(1 << langid.BITS)], np.uint64)
        assert np.allclose(model.probability(all_next).sum(axis=0), 1)
    total, _, _ = model.totals(texts[:2])
    plain = []
    for t in texts[:2]:
        s, first = langid.symbols([t], code)
        plain.append(np.log(model.probability(langid.grams(s, first))).sum(axis=0))
    assert np.allclose(total, plain, atol=1e-3)


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet")
    got = langid.identify(docs, ["doc_id", "lang"]).collect()
    assert len(got) == docs.count()
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 0.01 * len(got)


def test_awkward_rows(spark):
    en, de = "the cat and the dog sat on the mat ", "der hund und die katze sind auf dem dach "
    rows = [(i, (en if i % 2 else de) * (1 + i % 5), "en" if i % 2 else "de", i) for i in range(60)]
    rows += [(100, None, "en", 1), (101, "", None, 1), (102, "123 !?", "de", 1), (None, en, None, 1), (103, "ß" * 50000, None, 1),
             (103, en, None, 1), (103, en, None, 1), (104, "猫" * 50, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = langid.identify(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[None].lang_pred == "en"
    assert by[103].lang_pred in ("en", "de") and by[104].rejected
    assert [r for r in got if r.doc_id == 1][0].lang_pred == "en"
    alone = {r.lang_pred for r in langid.identify(df.withColumn("lang", df.lang.substr(9, 9)).where("false")).collect()}
    assert alone == set()
    from pyspark.sql import functions as F
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
