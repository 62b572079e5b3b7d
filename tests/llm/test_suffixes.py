import hashlib
import random
from collections import Counter

import pytest

from millrace.llm import suffixes


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), text in zip(rows, texts):
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if count[text[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, letters="abcdé "):
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randint(1, 400))) for _ in range(25)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(base)
            a = rng.randrange(len(t))
            t = t[a:a + rng.randint(1, 300)]
            if rng.random() < 0.5:
                k = rng.randrange(len(t))
                t = t[:k] + rng.choice(letters) + t[k + 1:]
            parts.append(t)
        rows.append((i, "".join(parts)))
    rows += [(500, None), (501, ""), (502, "short"), (503, "a" * 700), (504, "ab" * 300), (None, base[0] * 3), (505, rows[0][1]), (505, rows[0][1])]
    return rows


@pytest.mark.parametrize("seed,length,group", [(1, 30, 20_000), (2, 60, 20_000), (3, 31, 2)])
def test_against_all_substrings(spark, monkeypatch, seed, length, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rows = rows_of(seed)
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, row int")
    out = suffixes.remove_repeats(df, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, out), key=str) == brute(rows, length)


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 256)
    monkeypatch.setattr(suffixes, "KEPT", 3)
    rows = rows_of(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffixes.remove_repeats(df, 30).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, out), key=str) == brute(rows, 30)


def test_sorting():
    rng = random.Random(5)
    texts = list({bytes(rng.choices(b"ab", k=rng.randint(1, 60))) for _ in range(300)} - {b""})
    texts = [t for t in texts if b"\0" not in t]
    groups = list(suffixes.shallow(texts, 8))
    heads = [texts[g[0]][:8].ljust(8, b"\0") for g in groups]
    assert heads == sorted(set(heads)) and sorted(i for g in groups for i in g) == list(range(len(texts)))

    def walk(node):
        if node.leaf is not None:
            return [texts[node.leaf]]
        return [t for k in sorted(node.next) for t in walk(node.next[k])]
    assert walk(suffixes.Trie.build(texts)) == sorted(texts)


def test_no_rows(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
