"""SimHash near-duplicates found through the Golay code.

The [23,12,7] code is perfect: every word of 23 bits lies within 3 bits of exactly one codeword. Decoding a
word and all words one bit away from it gives one or six codewords, and two words that differ in at most two
bits have one of them in common. A fingerprint is cut into three segments. If two fingerprints differ in at
most two bits, one segment is equal in both (pigeonhole), and the segment after it differs in at most two bits.
So (segment, codeword of the next segment) is a key that both share; what shares a key is compared bit by bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.components import components, local_stars
from millrace.llm.frames import by_slices, documents, numbered, utf8
from millrace.operators.sizing import small_side
from millrace.sources.staging import stage

#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0xC75
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 2
#: Keys with more different fingerprints than this go the other exact way, by single bit flips.
BUCKET = 512
AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of the word shingles of ``text``; 0 where there are no words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), ends[min(width, len(words)) - 1:].tolist()
    digest, seen = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, AT_ONCE):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(first[at:at + AT_ONCE], last[at:at + AT_ONCE])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        seen += bits.sum(axis=0, dtype=np.int32)
    return int(((seen * 2 > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document, fp the 64 bits as a signed long. Null and empty texts have 0."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x, width) for x in utf8(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])
    return documents(docs).mapInArrow(by_slices(work, 512, 1), "doc_id long, fp long")


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
    return rest


def _corrections() -> np.ndarray:
    """By syndrome, the error of at most three bits that has it."""
    one = 1 << np.arange(23)
    two = (one[:, None] ^ one)[np.triu_indices(23, 1)]
    three = np.unique((two[:, None] ^ one).ravel())
    three = three[np.bitwise_count(three) == 3]
    errors = np.concatenate([[0], one, two, three])
    table = np.empty(2048, np.int64)
    table[_syndrome(errors)] = errors
    return table


CORRECTIONS = _corrections()


def codewords(words: np.ndarray) -> np.ndarray:
    """For each word of 23 bits, the indices (12 bits) of the codewords of it and of its 23 neighbours."""
    near = words[:, None] ^ np.concatenate([[0], 1 << np.arange(23)])
    return (near ^ CORRECTIONS[_syndrome(near)]) >> 11


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys of each fingerprint, each once."""
    rows, out = [], []
    bits = fps.view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    for i, part in enumerate(parts):
        near = np.sort(codewords(parts[(i + 1) % 3]), axis=1)
        new = np.concatenate([np.ones((len(near), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
        r, c = np.nonzero(new)
        rows.append(r)
        out.append(i << 40 | part[r] << 12 | near[r, c])
    return np.concatenate(rows), np.concatenate(out)


def _explode_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    fps = batch.column(0).to_numpy()
    row, key = keys(fps)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row])], ["key", "fp"])


def _link(batch: pa.RecordBatch) -> pa.RecordBatch:
    left, right = [], []
    for fps in batch.column(0).to_pylist():
        fps = np.array(fps, np.int64)
        a, b = np.nonzero(np.bitwise_count((fps[:, None] ^ fps).view(np.uint64)) <= MAX_BITS)
        left.append(fps[a[a < b]])
        right.append(fps[b[a < b]])
    u, v = local_stars(np.concatenate(left), np.concatenate(right))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def linked(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) that connect all fingerprints ``fp`` (distinct) within two bits of each other.

    Buckets of up to ``bucket`` fingerprints are compared as a whole. Members of larger ones meet by the
    fingerprints one bit away: two within two bits have such a neighbour in common, or one is the other's,
    and no neighbour has more than 65 fingerprints around it, so those groups are bounded by themselves.
    """
    keyed = stage(fps.mapInArrow(by_slices(_explode_keys, 4096), "key long, fp long"), "golay")
    count = keyed.groupBy("key").count()
    some = keyed.join(count.where((F.col("count") > 1) & (F.col("count") <= bucket)).select("key"), "key")
    small = (some.groupBy("key").agg(F.collect_list("fp").alias("fps")).select("fps")
             .mapInArrow(by_slices(_link, 256), "u long, v long"))
    full = keyed.join(count.where(F.col("count") > bucket).select("key"), "key").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    near = (full.select("fp", F.explode(flips).alias("flip"))
            .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("near")).agg(F.collect_list("fp").alias("fps"))
            .where(F.size("fps") > 1).select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v"))
    return small.union(near)


def simhash_groups(docs: DataFrame, width: int = 3) -> DataFrame:
    """Groups of documents whose SimHash fingerprints are connected by differences of two bits or fewer.

    Returns (doc_id, fingerprint, component_id): the fingerprint as 16 hexadecimal digits, and the smallest
    doc_id of the group, the document itself included. Every row of ``docs`` gives one row, repeated rows too.
    Documents without words (null, empty or blank texts) have the fingerprint zero and are linked like any
    other. Rows without a doc_id are linked too, but name no group unless nothing else does (then null). An
    empty table gives an empty result. Equal fingerprints meet once, before the search. Other columns, whatever their
    names, play no part.
    """
    prints = stage(fingerprints(docs, width), "simhash")
    return prints.join(_named(prints, "doc_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(prints: DataFrame, name: str) -> DataFrame:
    """(fp, component_id): for each fingerprint, the smallest ``name`` of its group."""
    each = stage(prints.groupBy("fp").agg(F.min(name).alias("first")), "simhash-distinct")
    found = components(linked(each.select("fp")))
    labelled = each.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    return labelled.join(least, "component").select("fp", "component_id")


def one_of_each_group(docs: DataFrame, width: int = 3, scan: bool = False) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest doc_id stays.

    Of rows that share that doc_id, the first stays; rows without a doc_id stay only if their group has no other, the
    first of them. Documents without words are near-duplicates of each other.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = numbered(docs.withColumnsRenamed({c: f"own_{i}" for i, c in enumerate(others)}), scan, *[f"own_{i}" for i in range(len(others))])
    ids = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "row")
    prints = stage(fingerprints(rows.withColumn("doc_id", F.col("row")), width).withColumnRenamed("doc_id", "row")
                   .join(rows.select("row", ids.alias("id")), "row"), "simhash")
    kept = stage(_named(prints, "id").select(F.col("component_id.row").alias("row")).distinct(), "simhash-kept")
    return rows.join(small_side(kept), "row", "left_semi").select(
        *[F.col(c if c in ("doc_id", "text") else f"own_{others.index(c)}").alias(c) for c in docs.columns])
