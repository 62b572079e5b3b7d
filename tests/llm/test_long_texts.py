"""Very long texts and words: one text of a few megabytes, one word of 300,000 bytes."""

import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from millrace.llm import ctw, langid, mixing, sharding, simhash

RNG = random.Random(21)
WORDS = ["the", "house", "Number", "of", "things", "é", "and", "more"]
MANY = " ".join(RNG.choice(WORDS) + str(RNG.randrange(500)) for _ in range(300_000))
LONG_WORD = "before " + "aB" * 150_000 + " after it"
TEXTS = [(1, MANY), (2, LONG_WORD), (3, "the house"), (4, ""), (5, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "s", "en") for d, t in TEXTS], "doc_id long, text string, source string, lang string")


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def test_simhash(docs):
    got = {r.doc_id: r.fingerprint for r in simhash.simhash_groups(docs).collect()}
    assert got == {d: f"{fingerprint(t):016x}" for d, t in TEXTS}


def test_mixing(docs):
    got = {r.doc_id: r["size"] for r in mixing.mix(docs).collect()}
    assert got == {d: len((t or "").split()) for d, t in TEXTS}


def test_sharding(docs):
    got = {r.doc_id: (r["size"], r.text_crc32) for r in sharding.shard(docs).collect()}
    assert got == {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in TEXTS}


def test_language(spark, docs):
    assert len(MANY) > langid.PIECE
    labelled = [(100 + i, " ".join(random.Random(i).choice(words) for _ in range(30)), "s", lang)
                for lang, words in (("en", WORDS), ("xx", ["qqq", "zzz", "kkk", "wvw"])) for i in range(200)]
    both = docs.unionByName(spark.createDataFrame(labelled, docs.schema))
    got = {r.doc_id: r.lang_pred for r in langid.identify(both).where("doc_id < 10").collect()}
    assert got[1] == got[3] == "en" and got[4] == got[5] == "und"


def test_scores(docs):
    for r in ctw.score(docs).collect():
        text = dict(TEXTS)[r.doc_id] or ""
        assert r.n_tokens == len(text.split()) + 1 and math.isfinite(r.score) and r.score < 0
        assert r.bits_per_byte < 9
