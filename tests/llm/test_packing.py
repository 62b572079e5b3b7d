import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_key_walks_to_neighbours(n, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    key = packing.hilbert_key(points, bits)
    assert sorted(key) == list(range(1 << n * bits))
    walk = points[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_round_trip(spark, sf):
    rng = random.Random(1)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    texts += [None, "", " ", "a  b\n\n c", "don't <|endoftext|> é\0", texts[0], "x" * 5000]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] , "doc_id long, text string, length int").repartition(3)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]
    got = packing.pack(df, PATH).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
        pieces[r.doc_id].append((r.start, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == parts[0][2] <= 1024 and at.bit_count() == 1
    for doc, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(want[doc])
    assert len(pieces) == len(texts)


def test_alike_documents_are_near(spark):
    a, b = [random.Random(i).choices([f"{s}{j}" for j in range(50)], k=300) for i, s in enumerate("ab")]
    keys = packing.curve_keys([np.array([zlib.crc32(w.encode()) % 5000 for w in x]) for x in (a, a[:290], b, b[:290])])
    assert abs(keys[0] - keys[1]) < abs(keys[0] - keys[2])


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_added_tokens_have_their_ids(spark, tmp_path):
    from millrace.llm.queries import QUERIES

    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>\n\n<|endoftext|><|endoftext|>  y", "<|endoftext", "don't  stop ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]
    assert 50256 in want[0]
    got = QUERIES["op2_packing"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {*range(len(texts))}
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
