"""Packing documents into sequences along a space-filling curve, so that neighbours in a sequence are alike."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.frames import by_slices, documents
from millrace.llm.tokens import Encoder
from millrace.sources.staging import stage

#: A document is a vector of this many hashed token counts, projected to this many numbers of so many bits.
BUCKETS = 1024
DIMENSIONS = 4
BITS = 12
SEED = 20
END = 0


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point (rows of whole numbers below 2^bits) on the Hilbert curve.

    From the highest bit down, each level undoes the turn of the cube the point lies in (an exchange of the
    first axis with another, or a mirrored first axis); the rest is a Gray code over all levels.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            upper = (x[i] >> level & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level & 1)
    return key


@cache
def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS))


def curve_keys(documents_ids: list[np.ndarray]) -> np.ndarray:
    """Where on the curve documents of these tokens lie: those without tokens in its middle."""
    vectors = np.zeros((len(documents_ids), BUCKETS))
    for vector, ids in zip(vectors, documents_ids):
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # token ids hashed to buckets
        vector += np.bincount((mixed >> np.uint64(54)).astype(np.int64), minlength=BUCKETS)
    vectors = np.log1p(vectors)
    vectors -= vectors.mean(axis=1, keepdims=True)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = vectors @ _projection() / np.where(norm > 0, norm, 1)
    # the projections of a unit vector are spread normally; this makes them even
    even = [[min(int((1 + erf(p / 2 ** 0.5)) / 2 * (1 << BITS)), (1 << BITS) - 1) for p in point] for point in points.tolist()]
    return hilbert_key(np.array(even, np.int64).reshape(-1, DIMENSIONS), BITS)


@cache
def _encoder(path: str, added: bool) -> Encoder:
    return Encoder(path, added)


def tokenised(docs: DataFrame, path: str, added: bool = False) -> DataFrame:
    """(doc_id, curve, ids): ids with the end mark, as unsigned little-endian numbers of 16 bits if they fit."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(path, added)
        all_ids = [encoder.encode(x) for x in batch.column(1).to_pylist()]
        curve = curve_keys(all_ids)
        width = "<u2" if encoder.core.max_token_value < 1 << 16 else "<u4"
        packed = [np.append(x, END).astype(width).tobytes() for x in all_ids]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(curve, pa.int64()), pa.array(packed, pa.binary())],
                                          ["doc_id", "curve", "ids"])
    return documents(docs).mapInArrow(by_slices(work, 128, 1), "doc_id long, curve long, ids binary")


COLUMNS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
           "sequence_id": pa.int64(), "offset": pa.int64(), "sequence_tokens": pa.int64()}


def _cuts(left: int, size: int) -> list[int]:
    """The lengths of the last sequences: powers of two, which need no padding."""
    return [1 << b for b in range(size.bit_length(), -1, -1) if left >> b & 1]


def _pack(size: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fills sequences with the documents of a task in their order; pieces leave once theirs is full."""
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        open_: list[tuple] = []
        filled, number = 0, 0

        def closed(rows, sequence, total):
            return [(*r, first + sequence, at, total) for r, at in rows]

        def emit(rows):
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), COLUMNS.values())]
            return pa.RecordBatch.from_arrays(arrays, list(COLUMNS))

        # the pieces of the open sequence are kept with their ids: if it is the last, it is cut once more
        for batch in batches:
            done = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    n = min(size - filled, len(ids) - at)
                    open_.append((doc_id, at, ids[at:at + n], len(ids)))
                    filled += n
                    at += n
                    if filled == size:
                        done += closed(_rows(open_), number, size)
                        open_, filled, number = [], 0, number + 1
            if done:
                yield emit(done)
        rest = []
        for length in _cuts(filled, size):
            some, need = [], length
            while need:
                doc_id, at, ids, total = open_.pop(0)
                if len(ids) > need:
                    open_.insert(0, (doc_id, at + need, ids[need:], total))
                    ids = ids[:need]
                some.append((doc_id, at, ids, total))
                need -= len(ids)
            rest += closed(_rows(some), number, length)
            number += 1
        if rest:
            yield emit(rest)
    return run


def _rows(pieces: list[tuple]) -> list[tuple]:
    out, at = [], 0
    for doc_id, start, ids, total in pieces:
        out.append(((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total), at))
        at += len(ids)
    return out


def pack(docs: DataFrame, path: str, size: int = 1024, added: bool = False) -> DataFrame:
    """Pieces of documents in sequences of ``size`` tokens, one row per piece.

    Documents are ordered by the Hilbert key of their projected token vector (ties by doc_id, then by their
    ids) in ranges, and each task cuts its stretch of the curve into full sequences. What is left at its end
    becomes sequences whose lengths are powers of two, so nothing is padded; sequence_tokens is the length.
    A document is its tokens and the end mark 0; null and empty texts are the end mark alone, in the
    middle of the curve. Repeated rows and rows without a doc_id are packed like any other. An empty table gives an
    empty result. sequence_id holds the task in its upper bits. With ``added``, strings of the file's added tokens have those
    tokens' ids, as in the library's default setting, else they are ordinary text. Other columns, whatever their
    names, play no part.
    """
    tokens = stage(tokenised(docs, path, added), "tokens")
    ordered = tokens.repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id", "ids")
    wide = _encoder(path, added).core.max_token_value >= 1 << 16
    return ordered.select("doc_id", "ids").mapInArrow(_pack(size, wide), ", ".join(f"{c} long" for c in COLUMNS))
