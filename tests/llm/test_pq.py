import numpy as np

from millrace.llm import pq


def brute(rows, cosine=0.9):
    ids, sound = [r[0] for r in rows], []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        sound.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    link = [[i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= cosine for j, b in enumerate(sound)]
            for i, a in enumerate(sound)]
    low = list(ids)
    while True:
        new = [min([low[i], *(low[j] for j in range(len(ids)) if link[i][j])]) for i in range(len(ids))]
        if new == low:
            break
        low = new
    return sorted((d, sum(x), c, d == c) for d, x, c in zip(ids, link, low))


def rows_of(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 4, dim))
    points = np.concatenate([base + rng.standard_normal(base.shape) * s for s in (0, 0.02, 0.1, 0.15)])
    return [(i, (p * 10.0 ** (i % 5 - 2)).tolist()) for i, p in enumerate(points)]


def test_against_all_pairs(spark):
    rows = rows_of(1)
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16),
             (2004, [None, *[1.0] * 15]), (2005, [float("inf")] * 16), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2007, [2.0, 4.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, home int")
    assert sorted(map(tuple, pq.near_duplicates(df).collect())) == brute(rows)


def test_split_lists_give_the_same(spark, monkeypatch):
    rows = rows_of(2, 200)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(pq, "MEMBERS", 3)
    monkeypatch.setattr(pq, "VISITORS", 5)
    assert sorted(map(tuple, pq.near_duplicates(df).collect())) == brute(rows)


def test_bound_passes_all_near_pairs():
    rng = np.random.default_rng(3)
    unit = pq._unit(rng.standard_normal((600, 32)))
    unit = np.concatenate([unit, pq._unit(unit + 0.07 * rng.standard_normal(unit.shape))])
    index = pq.Index.fit(unit, len(unit), 0.9)
    home = index.home(unit)
    found = set()
    for at in range(len(index.coarse)):
        here = np.flatnonzero(home == at)
        codes, error = index.encode(unit[here], home[here])
        a, b = index.candidates(unit, at, codes, error)
        found |= set(zip(a.tolist(), here[b].tolist()))
    near = set(zip(*(x.tolist() for x in np.nonzero(unit @ unit.T >= 0.9))))
    assert near <= found and len(found) < 0.3 * len(unit) ** 2
    visits = index.visits(unit, home)
    assert np.mean([visits[a, home[b]] | visits[b, home[a]] for a, b in near]) > 0.999


def test_no_rows(spark):
    assert pq.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
