"""Substrings that occur more than once, by sorting suffixes.

A suffix array of everything is not needed to find strings of a given length that repeat. Each such string has one
anchor, its smallest hashed k-gram (the leftmost of them), so equal strings have it at the same place. Windows that follow
each other with the same anchor form a chunk. Only chunks whose anchor occurs twice are brought together; their
suffixes from the anchor on are sorted shallow first, by multikey quicksort over words of 8 bytes, and what then has a long
common prefix is put in order by blind tries. A trie's inner nodes are the sets of chunks that agree to the
right of the anchor up to some depth; within each, the order of the reversed left sides tells how far they also agree to the left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.frames import by_slices, numbered, slices
from millrace.operators.sizing import small_side
from millrace.sources.staging import stage

#: Bytes that are hashed or sorted at a time, and chunks that a task keeps to find equal ones.
BLOCK = 1 << 20
KEPT = 100_000
SHALLOW = 24
#: Chunks about one anchor that are sorted together; more are compared window by window.
GROUP = 20_000
BUCKET = 1 << 22
MULTIPLIER = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
SPREAD = 0x94D049BB133111EB


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spread_keys(chosen: np.ndarray) -> np.ndarray:
    """Hashes that were chosen for being small, spread over all values again."""
    h = (chosen ^ chosen >> np.uint64(32)) * np.uint64(SPREAD)
    return h ^ h >> np.uint64(29)


class Anchors:
    """Finds the anchors of all windows of ``length`` bytes; k-grams have half that length."""

    def __init__(self, length: int):
        self.length, self.k = length, max(1, length // 2)
        n = BLOCK + length + 1
        self.up = _powers(MULTIPLIER, n)
        self.down = _powers(pow(MULTIPLIER, -1, 1 << 64), n)

    def hashes(self, raw: np.ndarray) -> np.ndarray:
        """A hash of the k-gram at each place."""
        sums = np.concatenate([[np.uint64(0)], np.cumsum(raw * self.up[:len(raw)])])
        h = (sums[self.k:] - sums[:-self.k]) * self.down[:len(sums) - self.k]
        h ^= h >> np.uint64(31)
        h *= np.uint64(MIX)
        return h ^ h >> np.uint64(29)

    def chunks(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(hash, anchor, first window, last window) of the chunks of joined texts, as places in the whole."""
        size = np.array([len(x) for x in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
        if len(raw) < self.length:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
        h = self.hashes(raw)
        low = h >> np.uint64(24) << np.uint64(24) | np.arange(len(h), dtype=np.uint64)
        span, wide = 1, self.length - self.k + 1  # the minimum over ``wide`` places, by doubling
        while 2 * span <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[:-(wide - span)], low[wide - span:])
        at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        window = np.arange(len(at))
        end = np.repeat(np.cumsum(size), size)[:len(at)]
        good = window + self.length <= end
        new = good & np.concatenate([[True], (at[1:] != at[:-1]) | ~good[:-1]])
        last = good & np.concatenate([(at[1:] != at[:-1]) | ~good[1:], [True]])
        first, last = np.flatnonzero(new), np.flatnonzero(last)
        return spread_keys(h[at[first]]), at[first], first, last


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces of bounded size that overlap, so that each window lies in exactly one."""
    for at in range(0, max(1, len(text) - length + 1), BLOCK // 2):
        yield at, text[at:at + BLOCK // 2 + length - 1]


def _blocks(batches, length: int):
    """Joined pieces of bounded size: (row of each, where in its text each begins, the pieces)."""
    rows, starts, some, size = [], [], [], 0
    for batch in (some for whole in batches for some in slices(whole, 512, whole.schema.get_field_index("text"))):
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            if text is None or len(text) < length:
                continue
            for at, piece in _pieces(text, length):
                if some and size + len(piece) > BLOCK:
                    yield rows, starts, some
                    rows, starts, some, size = [], [], [], 0
                rows.append(row)
                starts.append(at)
                some.append(piece)
                size += len(piece)
    if some:
        yield rows, starts, some


def _digests(joined: bytes, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """A hash of each chunk and of the place of its anchor."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(joined[p:q + length], a - p) for a, p, q in zip(anchor.tolist(), first.tolist(), last.tolist())],
                    np.uint64).view(np.int64)


def _anchor_hashes(length: int):
    def run(batches):
        find = Anchors(length)
        for _, _, texts in _blocks(batches, length):
            h, anchor, first, last = find.chunks(texts)
            columns = h.view(np.int64), _digests(b"".join(texts), anchor, first, last, length)
            for at in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 100_000]) for c in columns], ["key", "digest"])
    return run


FOUND = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("copies", pa.int64()),
                   ("row", pa.int64()), ("at", pa.int64()), ("last", pa.int64())])


def _hit(h: np.ndarray, bitmap: tuple[np.ndarray, int]) -> np.ndarray:
    bits, size = bitmap
    top = h >> np.uint64(64 - size)
    return (bits[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63)) & np.uint64(1)).astype(bool)


def _chunks(length: int, shared):
    """Places of the chunks whose anchor may occur elsewhere (``copies`` is null), and, where chunks about it may differ, their
    texts, once per task and with the number of equal ones (``row`` is null)."""
    def run(batches):
        find = Anchors(length)
        again, differ = shared.value
        seen: dict[int, list] = {}

        def texts():
            rows = [(k, d, a, b, n, None, None, None) for d, (k, a, b, n) in seen.items()]
            seen.clear()
            return emit(list(zip(*rows)))

        def emit(columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FOUND.types)], schema=FOUND)
        for rows, starts, some in _blocks(batches, length):
            h, anchor, first, last = find.chunks(some)
            maybe = np.flatnonzero(_hit(h, again))
            if not len(maybe):
                continue
            h, anchor, first, last = (x[maybe] for x in (h, anchor, first, last))
            joined = b"".join(some)
            begin = np.concatenate([[0], np.cumsum([len(x) for x in some])])
            of = np.searchsorted(begin, first, side="right") - 1
            digest, key = _digests(joined, anchor, first, last, length), h.view(np.int64)
            nothing = [None] * len(h)
            yield emit((key, digest, nothing, nothing, nothing, np.array(rows)[of], np.array(starts)[of] + first - begin[of], last - first))
            mixed = np.flatnonzero(_hit(h, differ))
            for k, d, a, p, q in zip(*(x[mixed].tolist() for x in (key, digest, anchor, first, last))):
                if d in seen:
                    seen[d][3] += 1
                else:
                    seen[d] = [k, joined[p:a], joined[a:q + length], 1]
            if len(seen) > KEPT:
                yield texts()
        if seen:
            yield texts()
    return run


def _bitmap(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the upper bits of each key: at least 64 bits per key, up to 64 MB in all."""
    size = min(29, max(12, int(64 * max(1, keys.count())).bit_length()))
    top = F.shiftrightunsigned("key", 64 - size)
    words = (keys.select(top.alias("t")).groupBy(F.shiftright("t", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(t & 63 as int)))").alias("bits"))).toArrow()
    bits = np.zeros(1 << size - 6, np.uint64)
    bits[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bits, size


def common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    return n if a == b else n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def shallow(suffixes: list[bytes], depth: int = SHALLOW) -> Iterator[list[int]]:
    """Multikey quicksort over words: in order, the groups of suffixes that agree in their first ``depth`` bytes."""
    padded = np.frombuffer(b"".join(x[:depth].ljust(depth, b"\0") for x in suffixes), ">u8").reshape(-1, depth // 8)
    order, group = np.arange(len(suffixes)), np.zeros(len(suffixes), np.int64)
    for word in range(depth // 8):
        key = padded[order, word].astype(np.uint64)
        by = np.lexsort((key, group))
        order, key, old = order[by], key[by], group[by]
        group = np.cumsum(np.concatenate([[True], (old[1:] != old[:-1]) | (key[1:] != key[:-1])])[:len(order)])
        if len(order) and group[-1] == len(order):
            break  # all are told apart
    for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(part):
            yield part.tolist()


class Trie:
    """A blind trie: inner nodes know only how deep they are and by which byte to go on (-1: the end)."""

    __slots__ = ("depth", "next", "leaf")

    def __init__(self, depth: int, leaf: int | None = None):
        self.depth, self.next, self.leaf = depth, {}, leaf

    @staticmethod
    def build(texts: list[bytes]) -> Trie:
        root = Trie(0, 0)
        for i in range(1, len(texts)):
            text, node = texts[i], root
            while node.leaf is None:  # blind: bytes between the nodes are not looked at
                node = node.next.get(text[node.depth] if node.depth < len(text) else -1) or next(iter(node.next.values()))
            other = texts[node.leaf]
            depth = common(text, other)
            node, above, way = root, None, None
            while node.leaf is None and node.depth <= depth:
                if node.depth == depth:
                    break
                above, way = node, text[node.depth] if node.depth < len(text) else -1
                node = node.next[way]
            mine = text[depth] if depth < len(text) else -1
            if node.leaf is None and node.depth == depth:
                node.next[mine] = Trie(0, i)
                continue
            split = Trie(depth)
            split.next = {other[depth] if depth < len(other) else -1: node, mine: Trie(0, i)}
            if above is None:
                root = split
            else:
                above.next[way] = split
        return root


def agreeing(lefts: list[bytes], rights: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For different chunks about one anchor, the ranges (from, to) of distances between a window's start and the anchor at
    which another chunk has the same window."""
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    flipped = [x[::-1] for x in lefts]
    rank = {i: r for r, i in enumerate(sorted(range(len(lefts)), key=flipped.__getitem__))}
    # nodes with the depth of the one above, deepest last; equal right sides share a leaf
    groups: dict[bytes, list[int]] = {}
    for i, right in enumerate(rights):
        groups.setdefault(right, []).append(i)
    texts = list(groups)
    members = list(groups.values())
    todo, order = [(Trie.build(texts), -1)], []
    while todo:
        node, above = todo.pop()
        order.append((node, above))
        todo += [(x, node.depth) for x in node.next.values()]
    held: dict[int, list[int]] = {}
    for node, above in reversed(order):
        if node.leaf is None:
            own, depth = [i for x in node.next.values() for i in held.pop(id(x))], node.depth
            own.sort(key=rank.__getitem__)
        else:
            own, depth = sorted(members[node.leaf], key=rank.__getitem__), len(texts[node.leaf])
        held[id(node)] = own
        low, high = max(0, length - depth), length - above - 1
        if len(own) < 2 or low > max(len(lefts[i]) for i in own):
            continue
        near = [common(flipped[a], flipped[b]) for a, b in zip(own, own[1:])]
        for n, i in enumerate(own):
            best = min(high, max(near[n - 1] if n else 0, near[n] if n < len(near) else 0))
            if low <= best and len(own) > 1:
                found[i].append((low, best))
    return found


def _repeats(length: int):
    def run(table: pa.Table) -> pa.Table:
        """Of all chunks of a bucket, the ranges of windows (counted from a chunk's first) that occur elsewhere."""
        chunks: dict[bytes, list] = {}
        for digest, left, right, copies in zip(*(table.column(c).to_pylist() for c in ("digest", "left", "right", "copies"))):
            if digest in chunks:
                chunks[digest][2] += copies
            else:
                chunks[digest] = [left, right, copies]
        names, all_ = list(chunks), list(chunks.values())
        rows = [(d, 0, len(a) + len(b) - length) for d, (a, b, n) in chunks.items() if n > 1]
        # all that agree around an anchor agree in its k-gram, so the shallow sort must not look further
        depth = min(SHALLOW, length // 2 // 8 * 8)
        for group in shallow([b for _, b, _ in all_], depth) if depth else [list(range(len(all_)))]:
            if len(group) > 1:
                ranges = agreeing([all_[i][0] for i in group], [all_[i][1] for i in group], length)
                for i, some in zip(group, ranges):
                    if all_[i][2] == 1:
                        left, last = len(all_[i][0]), len(all_[i][0]) + len(all_[i][1]) - length
                        rows += [(names[i], max(0, left - high), min(last, left - low)) for low, high in some if left - low >= 0]
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table({"digest": pa.array(columns[0], pa.int64()), "low": pa.array(columns[1], pa.int64()),
                         "high": pa.array(columns[2], pa.int64())})
    return run


def _windows(length: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for digest, left, right, copies in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = left + right
            rows += [(hashlib.blake2b(text[p:p + length], digest_size=16).digest(), digest, p, copies) for p in range(len(text) - length + 1)]
        types = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["window", "digest", "low", "copies"])
    return work


def repeated_ranges(rows: DataFrame, length: int) -> DataFrame:
    """(row, low, high): in the text of each ``row``, ranges of places at which strings of ``length`` bytes start that
    start somewhere else too. Nothing is left out; ranges may touch and overlap."""
    spark = rows.sparkSession
    keys = stage(rows.mapInArrow(_anchor_hashes(length), "key long, digest long").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("n > 1")
        .select("key", (F.col("d0") != F.col("d1")).alias("differ")), "anchors")
    mixed = keys.where("differ").select("key")
    shared = spark.sparkContext.broadcast((_bitmap(keys.select("key")), _bitmap(mixed)))
    found = stage(rows.mapInArrow(_chunks(length, shared), "key long, digest long, left binary, right binary, copies long, row long, "
                                  "at long, last long"), "chunks")
    # the bitmaps may say yes where the keys say no
    places = found.where("copies is null").join(keys, "key").select("digest", "row", "at", "last", "differ")
    equal = places.where("not differ").select("row", F.col("at").alias("low"), (F.col("at") + F.col("last")).alias("high"))
    chunks = found.where("copies is not null").select("key", "digest", "left", "right", "copies")
    per_key = stage(chunks.groupBy("key").count(), "chunk-keys")
    buckets = max(24, -(-chunks.count() * (length + length // 2) // BUCKET))
    some = chunks.join(per_key.where(F.col("count") <= GROUP).select("key"), "key", "left_semi")
    ranges = (some.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket")
              .applyInArrow(_repeats(length), "digest long, low long, high long"))
    many = per_key.where(F.col("count") > GROUP).select("key")
    if many.limit(1).count():
        each = stage(chunks.join(small_side(many), "key").select("digest", "left", "right", "copies").mapInArrow(
            by_slices(_windows(length), 256), "window binary, digest long, low long, copies long"), "windows")
        twice = each.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
        ranges = ranges.union(each.join(twice, "window").select("digest", "low", F.col("low").alias("high")).distinct())
    return equal.union(places.where("differ").join(ranges, "digest").select(
        "row", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high")))


def removed_spans(lows: list[int], highs: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs (from, to) of bytes covered by strings that start in the ranges."""
    out: list[list[int]] = []
    for low, high in sorted(zip(lows, highs)):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high + length)
        else:
            out.append([low, high + length])
    return [tuple(x) for x in out]


def _merged(length: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"low": a, "high": b} for a, b in removed_spans(lows, highs, length)]
                 for lows, highs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["row", "spans"])
    return work


def remove_repeats(docs: DataFrame, length: int = 200, scan: bool = False) -> DataFrame:
    """Documents without the bytes covered by a string of ``length`` bytes that also starts anywhere else.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_text (the other bytes, joined) and
    kept_sha256. Texts are UTF-8 bytes, and matches never cross documents; within a document they count, also where
    they overlap. All strings are judged on the input: every copy goes, the first too. Null and empty texts have no
    bytes, and texts shorter than ``length`` are kept whole. Every row is a document, repeated rows too; a row without a
    doc_id is treated like any other. An empty table gives an empty result. ``scan`` says that docs is a plain scan of files
    (see numbered). Other columns, whatever their
    names, play no part.
    """
    rows = numbered(docs, scan)
    ranges = repeated_ranges(rows.select("row", "text"), length)
    # gathered per document, so bounded by its own length
    spans = ranges.groupBy("row").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    spans = stage(spans.mapInArrow(by_slices(_merged(length), 1024), "row long, spans array<struct<low: long, high: long>>"), "spans")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = (text or "").encode()
            gone, kept, at = [(x["low"], x["high"]) for x in spans or []], [], 0
            for a, b in gone:
                kept.append(text[at:a])
                at = b
            kept = b"".join([*kept, text[at:]])
            out.append((doc_id, len(text), len(text) - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                          ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256"])
    return (rows.join(small_side(spans), "row", "left").select("doc_id", "text", "spans")
            .mapInArrow(by_slices(work, 256, 1), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_text binary, kept_sha256 string"))
