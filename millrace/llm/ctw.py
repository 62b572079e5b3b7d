"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions. A decision's node is the context of the last d bytes and the bits already known,
for every depth d up to DEPTH. A node estimates its bit after Krichevsky and Trofimov (KT) from the counts of the
training texts, and is weighted against the product of its children, the contexts one byte longer. Counts of byte
n-grams hold all nodes' counts, so they are all that is gathered from the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.frames import by_slices, documents, slices, utf8
from millrace.sources.staging import stage

DEPTH = 5
#: n-grams of the model that a scoring pass holds; a larger model is cut by the last two context bytes, and takes
#: several passes. Each pass is split into PARTS groups for training.
SLICE = 1_000_000
PARTS = 64
#: Words whose counts are sent to all tasks: at most this many, none longer than WORD bytes. The others are joined.
FREQUENT = 150_000
WORD = 64
END = b"\n"


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from learning; rows without a doc_id are not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def _mask(length: int) -> int:
    return (1 << 8 * length) - 1


def grams(texts: list[list[bytes]], at_once: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-grams of DEPTH + 1 bytes, the text of each) of words joined by spaces, each text ended by a line end and begun
    as if after others. So many positions at a time, however long a text is."""
    lines = [b" ".join(words) + END for words in texts]
    raw = np.frombuffer(END * DEPTH + (END * DEPTH).join(lines), np.uint8)
    size = np.array([len(x) for x in lines])
    begin = DEPTH + np.concatenate([[0], np.cumsum(size + DEPTH)[:-1]])
    for low in range(DEPTH, len(raw), at_once):
        high = min(len(raw), low + at_once)
        out = raw[low:high].astype(np.int64)
        for back in range(1, DEPTH + 1):
            out |= raw[low - back:high - back].astype(np.int64) << 8 * back
        edges = np.clip(np.stack([begin, begin + size], axis=1), low, high)
        own = np.repeat(np.resize([True, False], edges.size), np.diff(edges.ravel(), append=high))  # not the filling after a text
        yield out[own], np.repeat(np.arange(len(texts)), edges[:, 1] - edges[:, 0])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series from 8 on)."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift = np.where(low, shift + np.log(np.where(low, x, 1.0)), shift)
        x = np.where(low, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the KT probability of any sequence with these counts; a part at a time, as it takes many arrays between."""
    out = np.empty(len(zeros))
    for i in range(0, len(out), 1 << 16):
        a, b = zeros[i:i + (1 << 16)], ones[i:i + (1 << 16)]
        out[i:i + (1 << 16)] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)
    return out


@dataclass
class Level:
    """The nodes of one depth for one of the eight decisions: context << 8 | 1 and the bits known, sorted."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    #: The node of each n-gram of this depth, and the n-gram's bit there.
    at: np.ndarray
    bit: np.ndarray
    log: np.ndarray = field(default=None)
    #: Posterior weight of the node's own estimate against its children.
    weight: np.ndarray = field(default=None)

    @classmethod
    def of(cls, gram: np.ndarray, count: np.ndarray, l: int) -> Level:
        """For sorted n-grams of one depth."""
        byte = gram & 255
        key = gram >> 8 << 8 | 1 << l | byte >> (8 - l)
        bit = byte >> (7 - l) & 1
        new = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        first = np.flatnonzero(new)
        total = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
        ones = np.add.reduceat(count * bit, first) if len(first) else np.zeros(0, np.int64)
        return cls(key[first], total - ones, ones, (np.cumsum(new) - 1).astype(np.int32), bit.astype(bool))

    def one(self) -> np.ndarray:
        """The estimate that the next bit is one."""
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)


def truncated(gram: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams of ``length``, counts, place of each longer n-gram among them)."""
    short, at = np.unique(gram & _mask(length), return_inverse=True)
    return short, np.bincount(at, weights=count, minlength=len(short)).astype(np.int64), at


def children(parent: Level, child: Level, depth: int) -> np.ndarray:
    """The sum of the children's logs at each node of ``parent`` (of that depth)."""
    at = np.searchsorted(parent.key, child.key & _mask(depth + 1))
    return np.bincount(at, weights=child.log, minlength=len(parent.key))


def weigh(level: Level, below: np.ndarray | None) -> None:
    own = log_kt(level.zeros, level.ones)
    level.log = own if below is None else np.logaddexp(own, below) - np.log(2)
    level.weight = np.ones(len(own)) if below is None else np.exp(own - np.log(2) - level.log)


class Subtree:
    """n-grams of three bytes and more below contexts of two, and their weighted nodes one decision at a time."""

    def __init__(self, gram: np.ndarray, count: np.ndarray):
        self.tables, self.up = {DEPTH: (gram, count)}, {}
        for depth in range(DEPTH - 1, 1, -1):
            g, c, up = truncated(*self.tables[depth + 1], depth + 1)
            self.tables[depth], self.up[depth + 1] = (g, c), up.astype(np.int32)

    def levels(self, l: int) -> dict[int, Level]:
        out = {d: Level.of(g, c, l) for d, (g, c) in self.tables.items()}
        weigh(out[DEPTH], None)
        for d in range(DEPTH - 1, 1, -1):
            weigh(out[d], children(out[d], out[d + 1], d))
        return out


@dataclass
class Top:
    """Depths 0 and 1, which all subtrees share: at most 65,536 n-grams of two bytes."""

    gram: np.ndarray
    count: np.ndarray
    #: The nodes of depth 1 and the sums of their children's logs.
    below: tuple[np.ndarray, np.ndarray]

    def levels(self, l: int) -> tuple[Level, Level, np.ndarray]:
        short, count, up = truncated(self.gram, self.count, 1)
        zero, one = Level.of(short, count, l), Level.of(self.gram, self.count, l)
        keys, sums = self.below
        weigh(one, sums[np.searchsorted(keys, one.key)])
        weigh(zero, children(zero, one, 0))
        return zero, one, up


class Model:
    """All that is needed to score positions whose last two context bytes belong to one slice.

    Kept are the log probabilities of the n-grams that training has seen and, for all others, what tells them bit by bit: each
    node's key, estimate and weight, and at the full depth, where nodes are many and weigh all, only running counts.
    """

    def __init__(self, top: Top, gram: np.ndarray, count: np.ndarray):
        tree = Subtree(gram, count)
        self.gram, self.nodes = gram, []
        self.upto = np.concatenate([[0], np.cumsum(count)])
        log = np.zeros(len(gram))
        for l in range(8):
            zero, one, up1 = top.levels(l)
            own = tree.levels(l)
            places = [None, up1, np.searchsorted(top.gram, tree.tables[2][0] & _mask(2)), *[tree.up[d] for d in range(3, DEPTH + 1)]]
            got, left, kept = np.zeros(1), np.ones(1), []
            for d in range(DEPTH + 1):
                level = zero if d == 0 else one if d == 1 else own.pop(d)
                p, weight = level.one(), level.weight
                if d < DEPTH:
                    # estimates as doubles: one minus an estimate must not become zero where a decision went one way millions of times
                    kept.append((level.key, p, weight.astype(np.float32)))
                got, left = (got[places[d]], left[places[d]]) if d else (np.zeros(len(level.at)), np.ones(len(level.at)))
                p, weight = p[level.at], weight[level.at]
                got = got + left * weight * np.where(level.bit, p, 1 - p)
                left = left * (1 - weight)
            log += np.log10(got)
            self.nodes.append(kept)
        self.log = log.astype(np.float32)

    def score(self, gram: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each n-gram after the others. Other columns, whatever their
    names, play no part.
    """
        if not len(self.gram):
            return self._unseen(gram)
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        out, new = self.log[at].astype(np.float64), self.gram[at] != gram
        if new.any():
            out[new] = self._unseen(gram[new])
        return out

    def _unseen(self, gram: np.ndarray) -> np.ndarray:
        out, byte = np.zeros(len(gram)), gram & 255
        for l, depths in enumerate(self.nodes):
            bit = (byte >> (7 - l) & 1).astype(bool)
            got, left = np.zeros(len(gram)), np.ones(len(gram))
            for d, (keys, one, weights) in enumerate(depths):
                if not len(keys):
                    break
                key = (gram & _mask(d + 1)) >> 8 << 8 | 1 << l | byte >> (8 - l)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                weight = np.where(keys[at] == key, weights[at], 0.0)
                got += left * weight * np.where(bit, one[at], 1 - one[at])
                left *= 1 - weight
            # at the full depth: the n-grams that agree up to this bit, and those of them that go on with zero
            low = gram >> (8 - l) << (8 - l)
            begin, middle, end = (self.upto[np.searchsorted(self.gram, low + step)] for step in (0, 1 << (7 - l), 1 << (8 - l)))
            one = np.where(bit, end - middle, middle - begin)
            # without any, both say one half, as in all nodes that have never been met
            out += np.log10(got + left * (one + 0.5) / (end - begin + 1.0))
        return out


def _words(batch: pa.RecordBatch, column: int) -> list[list[bytes]]:
    return [x.lower().split() for x in utf8(batch.column(column))]


def _count_grams(batches):
    """Counts of the n-grams of a task, handed on whenever there are many."""
    held, size = [], 0

    def out():
        gram, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return gram, np.bincount(at, weights=np.concatenate([c for _, c in held]), minlength=len(gram)).astype(np.int64)

    def emit(gram, count):
        for i in range(0, len(gram), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(gram[i:i + 100_000]), pa.array(count[i:i + 100_000])], ["gram", "n"])
    for batch in batches:
        for some in slices(batch, 512, 0):
            for g, _ in grams(_words(some, 0)):
                held.append(np.unique(g, return_counts=True))
                size += len(held[-1][0])
                if size > 1_000_000:
                    held = [out()]
                    size = len(held[0][0])
                    if size > 500_000:
                        yield from emit(*held[0])
                        held, size = [], 0
    if held:
        yield from emit(*out())


def _count_words(batches):
    count: Counter = Counter()

    def emit():
        items = list(count.items())
        for i in range(0, len(items), 100_000):
            words, n = zip(*items[i:i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["word", "n"])
        count.clear()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            count.update((text or b"").lower().split())
            if len(count) > 200_000:
                yield from emit()
    yield from emit()


def _tops(table: pa.Table) -> pa.Table:
    gram, count = (table.column(c).to_numpy() for c in ("gram", "n"))
    order = np.argsort(gram)
    tree = Subtree(gram[order], count[order])
    tops = [tree.levels(l)[2] for l in range(8)]
    own, at = np.unique(np.concatenate([x.key & _mask(2) for x in tops]), return_inverse=True)
    return pa.table({"node": own, "log": np.bincount(at, weights=np.concatenate([x.log for x in tops]), minlength=len(own))})


def _part(context, parts: int):
    """The part that a context of two bytes belongs to, for numbers and for columns."""
    return (context * 40503) % 65536 % parts


_kept: tuple = (None, None)


def _model(shared) -> Model:
    """The model of a broadcast, built once per worker."""
    global _kept
    name, top, gram, count = shared.value
    if _kept[0] != name:
        _kept = (name, Model(top, gram, count))
    return _kept[1]


def trained(texts: DataFrame) -> tuple[Top, int, DataFrame]:
    """(top, number of passes, counts (gram, n, part)) of the texts."""
    plain = stage(texts.mapInArrow(_count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    passes = max(1, -(-plain.count() // SLICE))
    counts = plain.withColumn("part", _part(F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)), PARTS * passes))
    # both of these are bounded by the 65,536 pairs of bytes
    one = counts.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("g")).agg(F.sum("n").alias("n")).orderBy("g")
    below = (counts.groupBy("part").applyInArrow(_tops, "node long, log double").groupBy("node").agg(F.sum("log").alias("log"))
             .orderBy("node"))
    (gram, count), (node, log) = (_columns(x, *x.columns) for x in (one, below))
    return Top(gram, count, (node, log)), passes, counts


def _columns(rows: DataFrame, *names: str) -> list[np.ndarray]:
    table = rows.toArrow()
    return [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names]


def _sums(texts: list[list[bytes]], shared, at: int, parts: int) -> np.ndarray:
    """By text, the log10 probability of the positions that belong to slice ``at``."""
    out, bits = np.zeros(len(texts)), len(texts).bit_length()
    mine = _part(np.arange(65536), PARTS * parts) % parts == at  # by context of two bytes
    for gram, text in grams(texts):
        if parts > 1:
            own = mine[gram >> 8 & 0xFFFF]
            gram, text = gram[own], text[own]
        # sorted n-grams are found much faster; the text travels in the lower bits
        key = np.sort(gram << bits | text)
        gram = key >> bits
        new = np.diff(gram, prepend=-1) != 0  # each n-gram is scored once, wherever and however often it stands
        log = _model(shared).score(gram[new])
        out += np.bincount(key & (1 << bits) - 1, weights=log[np.cumsum(new) - 1], minlength=len(texts))
    return out


def _frequent(words: DataFrame) -> tuple[dict[bytes, float], int]:
    """log10(n + 1) of the words counted ``least`` times or more, at most FREQUENT; and ``least``."""
    short = words.where(F.length("word") <= WORD)
    least, held = 0, 0
    for r in short.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        if held + r["count"] > FREQUENT:
            least = r.n + 1
            break
        held += r["count"]
    word, n = _columns(short.where(F.col("n") >= least), "word", "n")
    return dict(zip(word, np.log10(n + 1.0).tolist())), least


def score(docs: DataFrame) -> DataFrame:
    """Scores of whole texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    The model learns from the texts that are not held out. Texts are lower-cased (A-Z) and taken as words with one
    space between and a line end, a token of its own. score is the log10 probability of that line under the context
    tree, bits_per_byte its code length per byte; base_score is that of the words by their counts with one added.
    n_known is the number of tokens that training texts have, train_tokens the number of tokens in these. Null and
    empty texts are the line end alone. Rows without a doc_id are scored, and learnt from. Every row gives one row.
    With nothing to learn from, every bit has one half. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = documents(docs).withColumn("held_out", held_out(F.col("doc_id")))
    learnt = rows.where(~F.col("held_out")).select("text")
    top, passes, counts = trained(learnt)
    words = stage(learnt.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    ends = learnt.count()
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, kinds = sums[0] + ends, sums[1] + (ends > 0)
    frequent, least = _frequent(words)
    table = spark.sparkContext.broadcast(frequent)
    end_log, size_log = float(np.log10(ends + 1)), float(np.log10(total + kinds + 1))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    if passes > 1:
        rows = stage(rows, "texts")

    def one(at: int):
        mine = counts.where(F.col("part") % passes == at).orderBy("gram")
        return spark.sparkContext.broadcast((f"{id(mine)}-{at}", top, *_columns(mine, "gram", "n")))  # a slice is bounded

    shared = one(0)

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, get = _words(batch, 1), table.value.get
        base, known, rare = [], [], []
        for ws in texts:
            logs = [get(w) for w in ws]
            missing = [w for w, x in zip(ws, logs) if x is None]
            known.append(len(ws) - len(missing) + (ends > 0))
            base.append(sum(x for x in logs if x is not None) + end_log - (len(ws) + 1) * size_log)
            rare.append([{"word": w, "times": n} for w, n in Counter(missing).items()])
        kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array([len(ws) + 1 for ws in texts], pa.int64()), pa.array(known, pa.int64()),
             pa.array(base), pa.array([sum(map(len, ws)) + max(1, len(ws)) for ws in texts], pa.int64()), pa.array(_sums(texts, shared, 0, passes)),
             pa.array(rare, kind)],
            ["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "bytes", "score", "rare"])

    scored = stage(rows.mapInArrow(by_slices(whole, 512, 1), "doc_id long, held_out boolean, row long, n_tokens long, n_known long, "
                   "base_score double, bytes long, score double, rare array<struct<word: binary, times: long>>"), "scored")
    more = scored.select("row", F.inline("rare")).join(
        words.where((F.col("n") < least) | (F.length("word") > WORD)), "word").groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_base"))
    out = scored.drop("rare").join(more, "row", "left")
    if passes > 1:
        rest = [rows.select("text", "row").mapInArrow(by_slices(_pass(one(at), at, passes), 512, 0), "row long, rest double")
                for at in range(1, passes)]
        out = out.join(reduce(DataFrame.union, rest).groupBy("row").agg(F.sum("rest").alias("rest")), "row", "left")
    else:
        out = out.withColumn("rest", F.lit(0.0))
    nothing = F.lit(0)
    full = F.col("score") + F.coalesce("rest", nothing)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", nothing)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("rare_base", nothing)).alias("base_score"),
        full.alias("score"), (-full / F.log10(F.lit(2.0)) / F.col("bytes")).alias("bits_per_byte"))


def _pass(shared, at: int, passes: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(_sums(_words(batch, 0), shared, at, passes))], ["row", "rest"])
    return work
