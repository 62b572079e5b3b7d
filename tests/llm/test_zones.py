import hashlib
import math

import numpy as np
import pytest

from millrace.llm import zones

SCHEMA = "vec_id long, embedding array<double>, cluster int, key string"


def brute(rows, dim, scale=64, k=16, rounds=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    def place(r):
        return (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=place)[:k]]

    def assigned():
        for i, v in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(centroids))
            yield i, v, c, d
    for _ in range(rounds):
        of = {}
        for _, v, c, _ in assigned():
            of.setdefault(c, []).append(v)
        for c, vs in of.items():
            centroids[c] = [sum(col) // len(vs) for col in zip(*vs)]
    last = list(assigned())
    inertia = sum(r[3] for r in last)
    of = {c: sum(r[3] for r in last if r[2] == c) for c in range(k)}
    return sorted(((i, c, d, of[c], inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for i, _, c, d in last), key=str)


def clustered(n=600, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((6, dim))[rng.integers(0, 6, n)] + 0.1 * rng.standard_normal((n, dim))
    return [(i, p.tolist()) for i, p in enumerate(points)]


def found(spark, rows, **how):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, zones.cluster(df, **how).collect()), key=str)


def test_against_all_distances(spark):
    rows = clustered()
    odd = [(700, None), (701, []), (702, [1.0] * 7), (703, [1.0] * 9), (704, [math.nan] * 8), (705, [None, *[1.0] * 7]),
           (706, [math.inf] * 8), (707, [0.0] * 8), (3, rows[3][1]), (3, rows[4][1]), (None, [0.5] * 8), (None, None)]
    odd += [(800 + i, rows[9][1]) for i in range(100)]
    assert found(spark, rows + odd, dim=8) == brute(rows + odd, 8)


def test_few_vectors_ties_and_negative_means(spark):
    rows = [(i, [-0.01 * (i % 3), 0.02 * (i % 2)]) for i in range(9)]
    assert found(spark, rows, dim=2, k=4) == brute(rows, 2, k=4)
    assert found(spark, rows[:3], dim=2) == brute(rows[:3], 2)
    assert found(spark, [(None, [1.0, 2.0])], dim=2) == brute([(None, [1.0, 2.0])], 2)


def test_no_rows(spark):
    assert found(spark, [], dim=8) == [] and found(spark, [(1, None)], dim=8) == []


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        found(spark, [(1, [1e30, 0.0])], dim=2)


def test_boxes_never_lose_the_nearest_and_prune():
    rng = np.random.default_rng(5)
    whole = np.array([p for _, p in clustered(3200, 8, 3)]) * 64 // 1
    centroids = np.floor(64 * rng.standard_normal((16, 8)))
    curve = zones.Curve.fit(whole)
    whole = whole[np.argsort(curve.keys(whole), kind="stable")]
    turned, starts = curve.turned(whole), np.arange(0, len(whole), zones.BLOCK)
    box = zones.box_candidates(np.minimum.reduceat(turned, starts), np.maximum.reduceat(turned, starts), curve.turned(centroids))
    far = ((whole[:, None, :] - centroids) ** 2).sum(axis=2)
    near = far == far.min(axis=1, keepdims=True)
    assert box[np.arange(len(whole)) // zones.BLOCK][near].all() and box.mean() < 0.3
