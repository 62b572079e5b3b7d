import hashlib
import math

import numpy as np
import pytest

from millrace.llm import pivots

SCHEMA = "vec_id long, embedding array<double>, label string, code int, far double"


def brute(rows, parts, entries=64, rounds=2, scale=256):
    sound = [(i, [math.floor(scale * x) for x in v], l) for i, v, l in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in sorted({len(v) for _, v, _ in sound}):
        kept = sorted((r for r in sound if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        where = pivots.cuts(dim, parts)
        books = [[r[1][c] for r in kept[:entries]] for c in where]

        def coded(v):
            return [min((sum((a - b) ** 2 for a, b in zip(v[c], e)), n) for n, e in enumerate(book)) for c, book in zip(where, books)]
        for _ in range(rounds):
            of = {}
            for _, v, _ in kept:
                for p, (_, e) in enumerate(coded(v)):
                    of.setdefault((p, e), []).append(v[where[p]])
            for (p, e), vs in of.items():
                books[p][e] = [sum(col) // len(vs) for col in zip(*vs)]
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, v, label in kept:
            best = coded(v)
            out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label, digest))
    total = {label: sum(r[2] for r in out if r[3] == label) for label in {r[3] for r in out}}
    return sorted(((i, c, e, total[label], h) for i, c, e, label, h in out), key=str)


def rows_of(n, dim, seed):
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((20, dim))[rng.integers(0, 20, n)] + 0.3 * rng.standard_normal((n, dim))
    return [(i * 7 % n, p.tolist(), None if i % 5 == 0 else f"l{i % 3}") for i, p in enumerate(points)]


def found(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, pivots.compress(df, **how).collect()), key=str)


def test_against_all_distances(spark):
    rows = rows_of(300, 12, 1)
    odd = [(None, [0.5] * 12, "x"), (None, None, None), (400, [], "l0"), (401, [math.nan] * 12, "l1"), (402, [None] * 12, "l1"),
           (403, [math.inf] * 12, "l1"), (404, [0.0] * 12, "l2"), (1, rows[1][1], "l0"), (1, rows[2][1], "l0"), (-5, [-0.001] * 12, None),
           (405, [1.0, 2.0, 3.0, 4.0, 5.0], "l0"), (406, [1.5, 2.0, 3.0, 4.0, 5.0], "l0")]
    assert found(spark, rows + odd, parts=4, entries=16) == brute(rows + odd, 4, 16)


def test_ties_and_few_vectors(spark):
    rows = [(i, [float(i % 3), 1.0, float(i % 2), 0.0], "a") for i in range(12)]
    assert found(spark, rows, parts=2, entries=8, scale=1) == brute(rows, 2, 8, scale=1)
    assert found(spark, rows[:2], parts=2) == brute(rows[:2], 2)


def test_no_rows(spark):
    assert found(spark, []) == [] and found(spark, [(1, None, "a")]) == []


def test_errors(spark):
    with pytest.raises(Exception, match="too large"):
        found(spark, [(1, [1e30] * 16, "a")])
    with pytest.raises(ValueError):
        found(spark, [(1, [1.0] * 16, "a")], entries=257)


@pytest.mark.parametrize("size", [1, 1000, 10 ** 6])
def test_bounds_skip_distances_but_no_answer(size):
    rng = np.random.default_rng(size)
    points = rng.integers(-size, size + 1, (3000, 4))
    book = pivots.Codebook.begin(points[:64])
    moved = pivots.Codebook(points[100:164], book.pivots)
    code, square, taken = moved.nearest(points, book.distances(points).astype(np.float32).astype(np.float64))
    far = ((points[:, None, :] - moved.entries) ** 2).sum(axis=2)
    assert (code == far.argmin(axis=1)).all() and (square == far.min(axis=1)).all()
    assert size == 1 or taken < 0.3 * far.size
