from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from millrace.llm import langid
from millrace.llm.tokens import Encoder
from millrace.sources.staging import stage
from tests.llm.test_mixing import filled
from tests.llm.test_simhash import brute


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], sf), name))
    return out


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "mix_sources", "pack"]
    assert {tuple(s.columns) for s in steps[:-1]} == {("doc_id", "text", "lang", "source", "n_chars")}


def test_languages(steps):
    gone = {r.doc_id for r in langid.identify(steps[0]).collect() if r.rejected}
    assert sorted(map(tuple, steps[1].collect())) == sorted(tuple(r) for r in steps[0].collect() if r.doc_id not in gone)
    assert len(gone) <= 0.01 * steps[0].count()


def test_one_of_each_group(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[1].collect())
    _, group = brute(rows)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(d for (d, _), g in zip(rows, group) if d == g)


def test_no_long_passage_is_left_twice(steps):
    before, after = ({r.doc_id: r.text.lower().split() for r in s.collect()} for s in steps[2:4])

    def shared(texts):
        where = defaultdict(set)
        for d, words in texts.items():
            for i in range(len(words) - 59):
                where[tuple(words[i:i + 60])].add(d)
        return {d for x in where.values() if len(x) > 1 for d in x}
    assert shared(before) and not shared(after)
    for d, words in after.items():  # cut, never changed; clean documents stay whole
        rest = iter(before[d])
        assert all(w in rest for w in words)
    assert {d for d in before if before[d] != after.get(d)} <= {
        r.doc_id for r in corpus_pipeline.chaining.passages(steps[2]).collect()}


def test_mix(steps):
    size, times = Counter(), Counter(r.doc_id for r in steps[4].collect())
    docs = steps[3].collect()
    for r in docs:
        size[r.source] += len(r.text.split())
    want = filled(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}, 3)
    for s in size:
        mine = [(times[r.doc_id], len(r.text.split())) for r in docs if r.source == s]
        assert abs(sum(n * w for n, w in mine) - want[s]) <= max(w for _, w in mine) and max(n for n, _ in mine) <= 3


def test_packed_tokens(steps):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, len(encoder.encode(r.text)) + 1) for r in steps[4].collect())
    tokens = Counter()
    for r in steps[5].collect():
        tokens[r.doc_id, r.doc_tokens] += r.length
    assert tokens == {(d, n): n * times for (d, n), times in want.items()}


def test_run(spark, sf, steps):
    out = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, out.drop("sequence_id", "offset", "sequence_tokens", "start", "length", "ids_crc32").distinct().collect())) == sorted(
        map(tuple, steps[5].select("doc_id", "doc_tokens").distinct().collect()))
    assert out.agg({"length": "sum"}).first()[0] == steps[5].agg({"length": "sum"}).first()[0]
    assert np.isfinite(out.count())


def test_awkward_documents(spark, sf):
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "the cat sat on the mat", "en", "a", 22), (2, "the cat sat on the mat", "en", "a", 22),
            (3, "a " * 3000, "en", None, 6000), (4, "\n", None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.where("false"), docs.withColumn("row", docs.doc_id).withColumn("score", docs.text)):
        for name, step in corpus_pipeline.STAGES:
            columns = frame.columns
            frame = stage(step(spark, frame, sf), name)
            assert name == "pack" or frame.columns == columns
