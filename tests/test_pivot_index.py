"""The pivot index against brute force, and what it reads."""

import numpy as np
import pytest

from millrace.operators import nearest as N, pivots as P


@pytest.fixture(autouse=True)
def small_pieces(monkeypatch):
    monkeypatch.setattr(P, "PIECE_ROWS", 40)


def frames(spark, corpus, queries):
    return (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "qid bigint, vec array<double>"),
            spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, vec array<double>").repartition(4))


def brute(corpus, queries, k):
    out = set()
    for q, v in enumerate(queries):
        d = ((corpus - v) ** 2).sum(axis=1)
        out |= {(q, int(i), n) for n, i in enumerate(np.lexsort((np.arange(len(d)), d))[:k], 1)}
    return out


def clustered(seed, n=800, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims)) * 10
    return rng, centres[rng.integers(0, 20, n)] + rng.normal(size=(n, dims)) * 0.2


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_against_brute_force_at_any_scale(spark, scale):
    rng, corpus = clustered(1)
    corpus = np.concatenate([corpus, np.repeat(corpus[:1], 100, axis=0)]) * scale  # many copies of one vector: ties by id
    queries = np.concatenate([corpus[::90], rng.normal(size=(5, 8)) * 10 * scale])
    q, c = frames(spark, corpus, queries)
    store, read = P.index(c), []
    got = {(r.qid, r.id, r["rank"]) for r in P.search(q, store, 3, read).collect()}
    assert got == brute(corpus, queries, 3) and len(store.pieces) > 10


def test_reads_fewer_rows(spark):
    _, corpus = clustered(2)
    q, c = frames(spark, corpus, corpus[:1] + 0.01)
    read = []
    found = P.search(q, P.index(c), 5, read).collect()
    assert {(r.qid, r.id, r["rank"]) for r in found} == brute(corpus, corpus[:1] + 0.01, 5)
    assert 0 < sum(read) < 0.3 * len(corpus)
    exact = {(r.id, r.distance) for r in N.nearest(q, c, 5).collect()}
    assert {(r.id, r.distance) for r in found} == exact


def test_few_rows_blocks_and_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    corpus, queries = rng.normal(size=(7, 3)), rng.normal(size=(9, 3))
    q, c = frames(spark, corpus, queries)
    monkeypatch.setattr(P, "WEIGHED", 2)
    assert {(r.qid, r.id, r["rank"]) for r in P.search(q, P.index(c), 10).collect()} == brute(corpus, queries, 10)
    assert P.search(q, P.index(c.limit(0)), 3).collect() == [] and P.search(q.limit(0), P.index(c), 3).collect() == []
    with pytest.raises(ValueError, match="differ"):
        P.index(c.union(spark.createDataFrame([(9, [1.0])], "id bigint, vec array<double>")))
