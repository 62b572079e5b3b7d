"""Both ways of searching against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from millrace.operators import lexical
from millrace.operators.lexical import from_index, indexed, search
from millrace.operators.nearest import compare_all, nearest


def brute(queries, corpus, k, metric):
    out = set()
    for qid, q in queries:
        q = np.array(q)
        dist = []
        for i, v in corpus:
            v = np.array(v)
            d = ((q - v) ** 2).sum() if metric == "l2" else 1 - q @ v / (np.linalg.norm(q) * np.linalg.norm(v))
            dist.append((round(float(d), 7), i))
        out |= {(qid, i, n) for n, (_, i) in enumerate(sorted(dist)[:k], 1)}
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 5)).round(3)
    # A third of the store are copies of one vector: ties must fall to the lower id.
    corpus = [(i, vectors[i % 40 if i % 3 else 0].tolist()) for i in range(180)]
    queries = [(i, rng.normal(size=5).round(3).tolist()) for i in range(9)]
    return (queries, corpus, spark.createDataFrame(queries, "qid bigint, vec array<double>"),
            spark.createDataFrame(corpus, "id bigint, vec array<float>").repartition(7))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_one_and_many_blocks_agree_with_brute_force(data, metric):
    queries, corpus, q, c = data
    corpus32 = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in corpus]
    want = brute(queries, corpus32, 4, metric)
    scan = {(r.qid, r.id, r["rank"]) for r in nearest(q, c, 4, metric).collect()}
    blocks = {(r.qid, r.id, r["rank"]) for r in nearest(q, c, 4, metric, broadcast_numbers=15).collect()}
    assert scan == want and blocks == want


def test_identical_vector_has_distance_zero(data):
    _, corpus, _, c = data
    asked = c.filter("id = 1").selectExpr("id as qid", "vec")
    first = nearest(asked, c, 1).first()
    assert first.distance == 0.0 and first.id == 1


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
@pytest.mark.parametrize("away", [0.0, 1e3])
def test_exact_at_any_scale(spark, scale, away):
    rng = np.random.default_rng(5)
    corpus = (rng.normal(size=(50, 6)) + away) * scale
    asked = corpus[:7] + rng.normal(size=(7, 6)) * scale * 0.01
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "qid bigint, vec array<double>")
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, vec array<double>")
    got = {(r.qid, r["rank"]): (r.id, r.distance) for r in nearest(q, c, 5).collect()}
    for i, v in enumerate(asked):
        far = ((corpus - v) ** 2).sum(axis=1)
        for n, at in enumerate(np.argsort(far)[:5], 1):
            assert got[i, n][0] == at and got[i, n][1] == pytest.approx(far[at], rel=1e-12)


def test_what_is_not_a_number_is_an_error(spark, data):
    _, _, q, _ = data
    bad = spark.createDataFrame([(1, [1.0, 2.0, float("nan"), 4.0, 5.0])], "id bigint, vec array<double>")
    with pytest.raises(PySparkException, match="not a number in the vector of id 1"):
        nearest(q, bad, 1).collect()


def test_wrong_length_is_an_error(spark, data):
    _, _, q, _ = data
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "id bigint, vec array<float>")
    with pytest.raises(PySparkException, match="wrong vector length for id 1"):
        nearest(q, bad, 1).collect()


def test_a_query_without_an_id_is_an_error(spark, data):
    bad = spark.createDataFrame([(1, [0.0] * 5), (None, [1.0] * 5)], "qid bigint, vec array<double>")
    with pytest.raises(TypeError):
        nearest(bad, data[3], 1).collect()


def test_no_queries(spark, data):
    _, _, q, c = data
    assert nearest(q.filter("false"), c, 3).count() == 0


def test_compare_all_in_one_and_many_scans(data):
    queries, corpus, q, c = data
    one = sorted(map(tuple, compare_all(q, c).collect()))
    many = sorted(map(tuple, compare_all(q, c, broadcast_numbers=10).collect()))
    assert len(one) == len(queries) and all(r[1] == len(corpus) for r in one)
    assert np.allclose(np.array(one), np.array(many))


def test_lexical_in_one_and_many_blocks(spark):
    docs = spark.createDataFrame([(i, f"alpha w{i % 5} w{i % 7} {'beta ' * (i % 3)}") for i in range(60)], "doc_id bigint, text string")
    asked = spark.createDataFrame([(i, f"Alpha w{i} BETA") for i in range(8)] + [(9, "nothing here")], "qid bigint, text string")
    one = sorted(map(tuple, search(asked, docs, 2).collect()))
    many = sorted(map(tuple, search(asked, docs, 2, block=7).collect()))
    again = sorted(map(tuple, from_index(asked, indexed(docs, 16), 2).collect()))
    assert one == many == again and {r[0] for r in one} == set(range(8))
    n, df_beta = 60, sum(i % 3 > 0 for i in range(60))
    # beta twice, w0 twice (i = 35 holds w0 from both), alpha once
    scores = {}
    import math
    from collections import Counter
    texts = {r.doc_id: r.text for r in docs.collect()}
    df = Counter(w for t in texts.values() for w in set(t.split()))
    assert df["beta"] == df_beta
    for i, t in texts.items():
        tf = Counter(t.split())
        scores[i] = round(sum((1 + math.log(tf[w])) * math.log(1 + n / df[w]) for w in ("alpha", "w0", "beta") if tf[w]), 6)
    best = sorted(scores, key=lambda i: (-scores[i], i))[:2]
    assert [r[1] for r in sorted(one, key=lambda r: r[3]) if r[0] == 0] == best


def test_lexical_cut_into_small_parts(spark, monkeypatch):
    """Bounded parts of a block, of its queries and of their shared words give the same."""
    docs = spark.createDataFrame([(i * 3 % 61, f"a w{i % 5} w{i % 7} {'b ' * (i % 3)}") for i in range(61)] + [(70, None), (71, "")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(i, f"A w{i} B w{i % 3}\tw1") for i in range(9)] + [(9, "nothing"), (10, None)], "qid bigint, text string")
    want = sorted(map(tuple, search(asked, docs, 3).collect()))
    for name, value in (("CELLS", 20), ("SHARED", 5), ("QUERIES", 2)):
        monkeypatch.setattr(lexical, name, value)
    assert sorted(map(tuple, search(asked, docs, 3, block=8).collect())) == want and len(want) == 27


def test_lexical_opens_only_blocks_that_may_win(spark):
    """One block holds the document that shares all words; a block that shares a common one cannot reach it."""
    rows = [(i, "common " + ("rare words here" if i == 5 else f"other{i}")) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    asked = spark.createDataFrame([(1, "common rare words")], "qid bigint, text string")
    opened = []
    real = lexical._scored

    def counted(pairs, *more):
        opened.append(pairs.count())
        return real(pairs, *more)
    lexical._scored, found = counted, None
    try:
        found = search(asked, docs, 1, block=8).collect()
    finally:
        lexical._scored = real
    assert [r.doc_id for r in found] == [5] and opened == [1, 0]


def test_sentiment_by_a_given_lexicon(spark):
    docs = spark.createDataFrame([(1, "Good good\tbad"), (2, "BAD news"), (3, "good bad"), (4, None), (5, "none")], "doc_id bigint, text string")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1), ("unused", 5)], "word string, weight bigint")
    got = {r.doc_id: (r.score, r.sentiment) for r in lexical.sentiment(docs, lexicon).collect()}
    assert got == {1: (1, "positive"), 2: (-1, "negative"), 3: (0, "neutral"), 4: (0, "neutral"), 5: (0, "neutral")}
    labelled = docs.join(spark.createDataFrame([(1, True), (2, False), (3, False)], "doc_id bigint, good boolean"), "doc_id")
    assert {tuple(r) for r in lexical.learnt_lexicon(labelled, 1).collect()} == {("good", 1), ("news", -1)}


def test_many_queries_are_scored_in_groups(spark, monkeypatch):
    """Groups of queries, each with its own best so far: blocks of pairs are as long as wide, and the results are brute force's."""
    from millrace.operators import nearest as N

    rng = np.random.default_rng(3)
    corpus, asked = rng.integers(-9, 9, (300, 4)).astype(float), rng.integers(-9, 9, (70, 4)).astype(float)
    at_once = []
    add = N._Best.add

    def noting(self, ids, vectors):
        at_once.append(len(self.queries))
        return add(self, ids, vectors)
    monkeypatch.setattr(N._Best, "add", noting)
    monkeypatch.setattr(N, "GROUP_QUERIES", 16)
    block = N.Block(np.arange(70), asked, [None] * 70)
    seen = {}
    monkeypatch.setattr(N, "_merge", lambda partial, k: partial)
    monkeypatch.setattr(N, "_scans", lambda q, c, score, *rest: seen.setdefault("score", score))
    monkeypatch.setattr(N, "_asked", lambda *a: None)
    score = N.nearest(None, None, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(300)), pa.array(corpus.tolist())], ["id", "vec"])
    got = sorted((q, d, i) for part in score(block, iter([batch.slice(0, 100), batch.slice(100)]), 4)
                 for q, i, d in zip(*(part.column(c).to_pylist() for c in ("qid", "id", "distance"))))
    want = sorted((q, d, i) for q in range(70) for d, i in sorted((float(((asked[q] - v) ** 2).sum()), i) for i, v in enumerate(corpus))[:3])
    assert got == want and max(at_once) == 16


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_single_precision_only_passes_pairs_over(monkeypatch, metric):
    """After the first rows, pairs are told apart by single precision; the answers are those of double precision at any scale."""
    from millrace.operators import nearest as N

    monkeypatch.setattr(N, "FIRST_ROWS", 16)
    rng = np.random.default_rng(11)
    by_double, scored = [], []
    maybe, merge = N._Best._maybe, N._Best._merge
    monkeypatch.setattr(N._Best, "_maybe", lambda self, some: by_double.append(len(some)) or maybe(self, some))
    monkeypatch.setattr(N._Best, "_merge", lambda self, qi, *rest: scored.append(len(qi)) or merge(self, qi, *rest))
    for scale, away, rest in ((1, 0, 1), (1, 1e4, 1), (1e-30, 0, 1), (1e30, 1e33, 1), (1e140, 0, 1e-9), (1e-140, 0, 1), (1e-200, 0, 1)):
        queries, corpus = ((rng.normal(size=(n, 12)) + away) * scale for n in (40, 900))
        corpus[300:600] = corpus[rng.integers(0, 300, 300)]  # ties
        corpus[700:] *= rest  # what comes later is far smaller
        corpus[650], queries[3] = 0, 0
        ids = rng.permutation(900)
        best = N._Best(queries, 5, metric)
        for low in range(0, 900, 250):
            best.add(ids[low:low + 250], corpus[low:low + 250])
        if metric == "l2":
            far = np.array([((corpus - q) ** 2).sum(axis=1) for q in queries])
        else:
            far = np.array([1.0 - (N._unit(corpus) * q).sum(axis=1) for q in N._unit(queries)])
        order = [np.lexsort((ids, d))[:5] for d in far]
        assert [best.i[best.q == n].tolist() for n in range(40)] == [ids[o].tolist() for o in order]
        assert np.array_equal(best.d, np.concatenate([d[o] for d, o in zip(far, order)]))
        if (scale, away) == (1, 0):
            assert sum(by_double) <= 20 and sum(scored) < 40 * 900 / 5
        by_double.clear()


def test_rows_without_bounds_do_not_hide_others():
    """A vector with an infinite value is near to nothing, and those beside it are found."""
    from millrace.operators import nearest as N

    rng = np.random.default_rng(12)
    corpus, queries = rng.normal(size=(400, 4)), rng.normal(size=(6, 4))
    corpus[350, 1], corpus[20, 2] = np.inf, 1e200
    best = N._Best(queries, 3, "l2")
    with np.errstate(over="ignore", invalid="ignore"):
        for low in (0, 200):
            best.add(np.arange(low, low + 200), corpus[low:low + 200])
    keep = [i for i in range(400) if i not in (20, 350)]
    far = np.array([((corpus[keep] - q) ** 2).sum(axis=1) for q in queries])
    assert [best.i[best.q == n].tolist() for n in range(6)] == [[keep[i] for i in np.argsort(d, kind="stable")[:3]] for d in far]


def test_small_parts_of_a_corpus_are_scored_together(spark, monkeypatch):
    """Each task gives k rows for every query, so their number follows the cores and not the files."""
    from millrace.operators import nearest as N

    merged = []
    merge = N._merge
    monkeypatch.setattr(N, "_merge", lambda partial, k: merged.append(partial.count()) or merge(partial, k))
    c = spark.range(2000).selectExpr("id", "array(id * 0.37 % 5, id * 0.11 % 7) as vec").repartition(100)
    q = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "qid bigint, vec array<double>")
    assert nearest(q, c, 2).count() == 8
    assert merged[0] <= 2 * 4 * N.PARTS_PER_CORE * spark.sparkContext.defaultParallelism < 2 * 4 * 100
