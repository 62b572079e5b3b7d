import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import ctw


class Plain:
    """The context tree node by node."""

    def __init__(self, lines):
        self.count = Counter()
        for line in lines:
            for at, context in self.steps(line):
                for d in range(ctw.DEPTH + 1):
                    for node, bit in self.path(context[len(context) - d:], line[at]):
                        self.count[node, bit] += 1
        self.kids = {}
        for (context, known), _ in self.count:
            if context:
                self.kids.setdefault((context[1:], known), set()).add(context)
        self.memo = {}

    def steps(self, line):
        padded = b"\n" * ctw.DEPTH + line
        return [(i, padded[i:i + ctw.DEPTH]) for i in range(len(line))]

    def path(self, context, byte):
        return [((context, 1 << l | byte >> 8 - l), byte >> 7 - l & 1) for l in range(8)]

    def kt(self, node):
        a, b = self.count[node, 0], self.count[node, 1]
        return sum(math.log(i + 0.5) for i in range(a)) + sum(math.log(i + 0.5) for i in range(b)) - sum(math.log(i + 1) for i in range(a + b))

    def weighted(self, node):
        if node not in self.memo:
            own = self.kt(node)
            if len(node[0]) < ctw.DEPTH:
                below = sum(self.weighted((c, node[1])) for c in sorted(self.kids.get(node, ())))
                high = max(own, below)
                own = high + math.log((math.exp(own - high) + math.exp(below - high)) / 2)
            self.memo[node] = own
        return self.memo[node]

    def bit(self, context, known, bit, d=0):
        node = (context[len(context) - d:], known)
        a, b = self.count[node, 0], self.count[node, 1]
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == ctw.DEPTH:
            return own
        w = math.exp(self.kt(node) - math.log(2) - self.weighted(node))
        return w * own + (1 - w) * self.bit(context, known, bit, d + 1)

    def score(self, line):
        return sum(math.log10(self.bit(c, known, bit)) for at, c in self.steps(line)
                   for (_, known), bit in self.path(b"", line[at]))


def rows_of():
    rng = random.Random(1)
    words = ["the", "cat", "sat", "On", "mäat", "x", "long-word" * 9]
    rows = [(i, rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(30)]
    return rows + [(40, None), (41, ""), (None, "the cat"), (42, "never MET 1234"), (42, "never MET 1234"), (43, "zz zz")]


def want(rows):
    out, learnt, lines = [], [], []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        held = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2
        out.append((doc, held, words))
        if not held:
            learnt += [*words, b"\n"]
            lines.append(b" ".join(words) + b"\n")
    count, tree = Counter(learnt), Plain(lines)
    result = []
    for doc, held, words in out:
        tokens = [*words, b"\n"]
        base = sum(math.log10((count[t] + 1) / (len(learnt) + len(count) + 1)) for t in tokens)
        result.append((doc, held, len(tokens), sum(count[t] > 0 for t in tokens), len(learnt), base, tree.score(b" ".join(words) + b"\n")))
    return result


@pytest.mark.parametrize("slice_,frequent", [(4_000_000, 300_000), (40, 2)])
def test_against_node_by_node(spark, monkeypatch, slice_, frequent):
    monkeypatch.setattr(ctw, "SLICE", slice_)
    monkeypatch.setattr(ctw, "FREQUENT", frequent)
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")
    key = lambda r: (str(r[0]), r[2:4])
    got = sorted((tuple(r)[:7] for r in ctw.score(df).collect()), key=key)
    assert any(r[1] for r in got)
    for mine, plain in zip(got, sorted(want(rows), key=key), strict=True):
        assert mine[:5] == plain[:5]
        assert mine[5:] == pytest.approx(plain[5:], rel=1e-5)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2.5, 7.9, 100.5, 1e6])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x])


def test_bytes_sum_to_one():
    texts = [[b"ab", b"abc"], [b"abab"]] * 3
    gram, count = np.unique(np.concatenate([g for g, _ in ctw.grams(texts, 4)]), return_counts=True)
    tops = [ctw.Subtree(gram, count).levels(l)[2] for l in range(8)]
    g, c, _ = ctw.truncated(gram, count, 2)
    own, at = np.unique(np.concatenate([x.key & 0xFFFF for x in tops]), return_inverse=True)
    sums = np.bincount(at, weights=np.concatenate([x.log for x in tops]))
    model = ctw.Model(ctw.Top(g, c, (own, sums)), gram, count)
    for context in (b"\nab a", b"zzzab", b"zzzzz"):
        after = (int.from_bytes(context, "big") << 8) + np.arange(256)
        assert np.isclose((10.0 ** model.score(after)).sum(), 1, atol=1e-5)


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ctw.score(empty).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r, = ctw.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert r.score == pytest.approx(-4 * 8 * math.log10(2)) and r.bits_per_byte == pytest.approx(8)


def test_what_never_came_after_millions_is_finite():
    """A decision that went one way a hundred million times leaves a little for the other way."""
    learnt = {b"abcde" + bytes([x]): 10 ** 7 for x in range(0x61, 0x7b)} | {bytes([x]) * 4 + b"ee": 10 ** 7 for x in range(0x61, 0x7b)}
    gram, count = map(np.array, zip(*sorted((int.from_bytes(g, "big"), n) for g, n in learnt.items())))
    tops = [ctw.Subtree(gram, count).levels(l)[2] for l in range(8)]
    g, c, _ = ctw.truncated(gram, count, 2)
    own, at = np.unique(np.concatenate([x.key & 0xFFFF for x in tops]), return_inverse=True)
    sums = np.bincount(at, weights=np.concatenate([x.log for x in tops]))
    model = ctw.Model(ctw.Top(g, c, (own, sums)), gram, count)
    after = (int.from_bytes(b"zzzze", "big") << 8) + np.arange(256)
    with np.errstate(divide="raise"):
        log = model.score(after)
    assert np.isfinite(log).all() and np.isclose((10.0 ** log).sum(), 1, atol=1e-5)


def test_slices_are_told_by_context_not_by_position(monkeypatch):
    told = []
    part = ctw._part

    def counted(context, parts):
        told.append(len(context))
        return part(context, parts)

    class Even:
        def score(self, gram):
            return np.ones(len(gram))

    monkeypatch.setattr(ctw, "_part", counted)
    monkeypatch.setattr(ctw, "_model", lambda shared: Even())
    texts = [[b"some", b"words"] * 9000, [], [b"x"]]
    sums = sum(ctw._sums(texts, None, at, 3) for at in range(3))
    assert sums.tolist() == [99000.0, 1.0, 2.0]
    assert max(told) <= 65536


def test_grams_of_pieces_are_those_of_the_whole():
    texts = [[b"ab", b"c"], [], [b"d" * 40], [], [b"e"]]
    (gram, text), = ctw.grams(texts)
    for at_once in (1, 3, 7):
        some = list(ctw.grams(texts, at_once))
        assert np.concatenate([g for g, _ in some]).tolist() == gram.tolist()
        assert np.concatenate([t for _, t in some]).tolist() == text.tolist() == [0] * 5 + [1] + [2] * 41 + [3] + [4] * 2
