import random
import zlib
from collections import defaultdict

from millrace.llm import sharding


def test_difference_keeps_sums():
    rng = random.Random(2)
    rows = [(rng.randint(1, 1000), 0, 0, 0) for _ in range(200)]
    where, sums = sharding.difference(rows)
    mine = [0] * 4
    for row, w in zip(rows, where):
        assert sorted(w) == [0, 1, 2, 3]
        mine[w[0]] += row[0]
    assert tuple(mine) == sums and max(sums) - min(sums) <= 3
    assert sharding.difference([(8, 0), (7, 0), (6, 0), (5, 0), (4, 0)])[1] in ((14, 16), (16, 14))


def test_shards(spark):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randint(0, 300)) for i in range(500)] + [(None, None), (7, None), (8, ""), (8, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int").repartition(5)
    got = sharding.shard(df).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    slots, size, shard_of = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
        shard_of[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values())
    assert max(len(s) for k, s in shard_of.items() if k[0] > 1) == 1
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_no_rows(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).collect() == []
