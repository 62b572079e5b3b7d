import random

import numpy as np
import xxhash

from millrace.llm import simhash


def brute(rows, width=3):
    prints = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return prints, groups([r[0] for r in rows], prints)


def groups(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    best = {}
    for i, d in enumerate(ids):
        best[root(i)] = min(best.get(root(i), d), d)
    return [best[root(i)] for i in range(len(ids))]


def test_codewords_meet_within_two_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    flips = (1 << rng.integers(0, 23, 3000)) | (1 << rng.integers(0, 23, 3000))
    a, b = simhash.codewords(words), simhash.codewords(words ^ flips)
    assert all(set(x) & set(y) for x, y in zip(a, b))
    assert {len(set(x)) for x in a} == {1, 6}


def test_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 60, 200]))
        rows.append((i, " ".join(words)))
        words[rng.randrange(len(words))] = "X"
        rows.append((1000 - i, "\t".join(words).upper()))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, rows[0][1]), (2003, rows[0][1])]
    prints, want = brute(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = sorted(map(tuple, simhash.simhash_groups(df).collect()))
    assert got == sorted((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, want))


def test_buckets_and_flips_agree(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(20)]
    for _ in range(300):
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted(set(prints))
    want = groups(prints, prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bucket in (512, 3):
        found = dict(map(tuple, simhash.components(simhash.linked(df, bucket)).collect()))
        mine = [found.get(p, p) for p in signed]
        assert [[a == b for b in mine] for a in mine] == [[a == b for b in want] for a in want]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).collect() == []
