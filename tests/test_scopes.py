"""Search and answers where each question sees its own part of the store."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import answering as A, batch as B, nearest as N
from millrace.operators.retrieval import NO_CONTEXT


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    corpus = [(i, rng.integers(-3, 4, 4).astype(float).tolist(), rng.choice(["a", "b", "c", "d", None])) for i in range(300)]
    sets = [["a"], ["b", "c"], ["c", "b", "c"], ["d", None], [], None, ["zz"], ["a", "b", "c", "d"]]
    queries = [(i, rng.integers(-3, 4, 4).astype(float).tolist(), sets[i % len(sets)]) for i in range(40)]
    return (queries, corpus, spark.createDataFrame(queries, "qid bigint, vec array<double>, sees array<string>"),
            spark.createDataFrame([(i, v, str(o) if o is not None else None) for i, v, o in corpus], "id bigint, vec array<double>, of string").repartition(5))


def brute(queries, corpus, k):
    out = set()
    for qid, q, sees in queries:
        dist = sorted((float(((np.array(q) - np.array(v)) ** 2).sum()), i) for i, v, of in corpus
                      if of is not None and sees and of in sees)[:k]
        out |= {(qid, i, d, n) for n, (d, i) in enumerate(dist, 1)}
    return out


@pytest.mark.parametrize("numbers", [4_000_000, 60])
def test_scoped_search_against_brute_force(data, numbers):
    queries, corpus, q, c = data
    got = {tuple(r) for r in N.nearest(q, c, 3, broadcast_numbers=numbers, scoped=True).collect()}
    assert got == brute(queries, corpus, 3)


def test_many_values_go_by_a_join(data, monkeypatch):
    queries, corpus, q, c = data
    monkeypatch.setattr(N, "FILTER_VALUES", 2)
    assert {tuple(r) for r in N.nearest(q, c, 2, scoped=True).collect()} == brute(queries, corpus, 2)


def test_few_values_are_a_filter_of_the_scan(spark, tmp_path):
    store = spark.createDataFrame([(i, [float(i)], f"v{i % 4}") for i in range(40)], "id bigint, vec array<double>, of string")
    store.write.partitionBy("of").parquet(str(tmp_path / "store"))
    asked = spark.createDataFrame([(1, [3.0], ["v1"])], "qid bigint, vec array<double>, sees array<string>")
    cut = N._in_sight(spark.read.parquet(str(tmp_path / "store")), asked)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(of" in plan and "v1" in plan and {r.of for r in cut.collect()} == {"v1"}


def test_an_answer_or_a_refusal_for_every_scope(spark):
    docs = spark.createDataFrame(
        [(1, "Leave is granted for ten days. Ask HR.", "hr.pdf", "hr"), (2, "The catalog lists the product at nine. More.", "cat.pdf", "sales"),
         (3, "Leave the product on the shelf. Now.", "shop.pdf", "shop")], "doc_id bigint, text string, source string, team string")
    chunks = A.indexed(docs, make_vectors=A.by_digest, of="team")
    assert set(chunks.columns) == {"id", "doc_id", "source", "page", "text", "vec", "of"}
    asked = spark.createDataFrame([(1, "leave days"), (2, "product catalog")], "qid bigint, question string")
    scopes = {"HR": ("Only HR. Topics: leave", ["hr"]), "sales": ("Topics: product", ["sales", "shop"]), "none": ("Topics: leave, product", ["law"])}
    got = {(r.qid, r.scope): r for r in A.answer_scopes(asked, scopes, chunks, B.topics_client, k=2, make_vectors=A.by_digest).collect()}
    assert len(got) == 6
    assert got[1, "HR"].answer == "Leave is granted for ten days." and got[1, "HR"].cards.count("### ") == 1
    assert got[2, "sales"].answer == "The catalog lists the product at nine." and got[2, "sales"].cards.count("### ") == 2
    assert not got[2, "HR"].on_topic and got[2, "HR"].answer.startswith('Someone asked: "product catalog"') and got[2, "HR"].cards == ""
    # on topic for the guard, but the store shows nothing to this scope
    assert got[1, "none"].on_topic and got[1, "none"].answer == NO_CONTEXT


def test_digest_embedding():
    embed = B.digest_embedder(8)
    a, b, c = embed(["One two, TWO", "two one two", " .\n"])
    assert (a == b).all() and not c.any() and 990 <= np.linalg.norm(a) <= 1000 and (a == np.floor(a)).all()
