import numpy as np

from millrace.llm import collisions


def brute(rows, k=10, every=100):
    sound = [(i, np.array(v, float)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in sound:
        if q % every == 0:
            far = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, x in sound if i != q and len(x) == len(v))
            out[q] = far[:k]
    return out


def compare(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    want, got = brute(rows, **options), {}
    for r in sorted(collisions.nearest(df, **options).collect()):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    assert got.keys() == {q for q, x in want.items() if x}
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in got)
    assert all(len(got[q]) == len(want[q]) and got[q] == sorted(got[q]) for q in got)
    exact = {(q, i): s for q in want for s, i in brute([r for r in rows], k=10 ** 9, **{k: v for k, v in options.items() if k != "k"})[q]}
    assert all(abs(exact[q, i] - s) <= 1e-9 * max(1, s) for q in got for s, i in got[q])
    return hit / sum(map(len, want.values()))


def test_recall_on_noise_and_clusters(spark):
    rng = np.random.default_rng(1)
    noise = rng.standard_normal((1500, 24))
    near = noise[:500] + 0.1 * rng.standard_normal((500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([noise, near]))]
    assert compare(spark, rows, every=50) >= 0.95
    assert compare(spark, [(i, [x * 1e-6 for x in v]) for i, v in rows[:600]], every=50) >= 0.95


def test_awkward_rows(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(60)]
    rows += [(100, None), (200, [0.0, 0.0]), (300, [float("nan"), 1.0]), (400, [None, 1.0]), (None, [1.0, 1.0]),
             (500, [3.0, 1.0]), (500, [3.0, 1.0]), (600, [1.0, 2.0, 3.0]), (700, [1.0, 2.0, 3.5])]
    assert compare(spark, rows, every=100) == 1.0


def test_no_rows(spark):
    assert collisions.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
