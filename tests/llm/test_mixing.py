import random
import re

import pytest

from millrace.llm import mixing


def filled(sizes, weights, epochs):
    """Clamp and hand on the excess until nobody is above the limit."""
    out, free, left = {}, dict(sizes), float(sum(sizes.values()))
    while free:
        share = left / sum(weights[s] for s in free)
        over = [s for s in free if share * weights[s] >= epochs * free[s]]
        if not over:
            return out | {s: share * weights[s] for s in free}
        for s in over:
            out[s] = float(epochs * free.pop(s))
            left -= out[s]
    return out


def test_targets_and_sums(spark):
    rng = random.Random(1)
    rows, n = [], 0
    for source, docs, longest in (("b", 300, 90), ("a", 20, 10), (None, 200, 400), ("é", 5, 3), ("c", 900, 50), ("empty", 3, 0)):
        for _ in range(docs):
            n += 1
            rows.append((n, " \n".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, longest))), source, n))
    rows += [(n, rows[-4][1], "c", 0), (None, None, "b", 0), (None, "x y", "b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(df.drop("size"), carry=["doc_id", "source"]).collect()
    assert got is not None and len(got) == len(rows)
    size = {}
    for _, text, source, _ in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    want = filled(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    for s in order:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {size[s]}
        assert mine[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine) / 2 + 1e-6
        assert all(r.taken <= 3 * r.size and r.taken == r.repeats * r.size for r in mine)
    again = mixing.mix(df.drop("size").repartition(7), carry=["doc_id", "source"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_repeats_rows(spark):
    df = spark.createDataFrame([(i, "a b c", f"s{i % 2}") for i in range(40)], "doc_id long, text string, source string")
    out = mixing.repeated(df, weights=[5, 1], epochs=3)
    assert out.columns == df.columns
    count = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert count == {"s0": 33, "s1": 7}


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).collect() == []
