"""Model calls and the retrieval job with clients of our own."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import answering as A, batch as B


def test_one_answer_per_prompt(spark):
    df = spark.createDataFrame([(i, f"No. {i}! rest") for i in range(200)] + [(999, None)], "i int, p string")
    got = {r.i: r.a for r in B.complete(df, "p", "a").collect()}
    assert len(got) == 201 and got[7] == "No." and got[999] == ""


def test_retries_then_gives_up(spark):
    def flaky():
        calls = []

        def client(prompts):
            calls.append(1)
            if len(calls) < 3:
                raise TimeoutError("slow")
            return ["ok"] * len(prompts)
        return client

    df = spark.createDataFrame([("x",)], "p string")
    assert B.complete(df, "p", "a", flaky, retries=2, wait=0.0).first().a == "ok"
    with pytest.raises(PySparkException, match="slow"):
        B.complete(df, "p", "a", flaky, retries=1, wait=0.0).collect()


def test_missing_answers_are_an_error(spark):
    df = spark.createDataFrame([("x",), ("y",)], "p string").coalesce(1)
    with pytest.raises(PySparkException, match="2 prompts, but 1 answers"):
        B.complete(df, "p", "a", lambda: (lambda prompts: ["one"])).collect()


def test_embedding_model(spark):
    df = spark.createDataFrame([("abc",), ("a",)], "t string")
    make = lambda: (lambda texts: np.array([[len(t), 1.0] for t in texts]))
    assert sorted(r.v for r in B.embed_with(df, "t", "v", make).collect()) == [[1.0, 1.0], [3.0, 1.0]]


@pytest.fixture(scope="module")
def chunks(spark):
    docs = spark.createDataFrame(
        [(1, "Leave is granted for ten days. Ask HR.", "hr.pdf"), (2, "The brand colour is blue.", "brand.pdf"), (3, "Sales rose in May.", "sales.pdf")],
        "doc_id bigint, text string, source string")
    return A.indexed(docs)


def test_rag_answers_and_refuses(spark, chunks):
    guard = "Only HR. Topics: leave, conduct"
    queries = spark.createDataFrame([(1, "How many days of leave are granted?", guard), (2, "What is the brand colour?", guard)], "qid bigint, question string, guard string")
    got = {r.qid: r for r in A.answer_queries(queries, chunks, B.topics_client, k=2, rerank=True).collect()}
    assert got[1].on_topic and got[1].answer == "Leave is granted for ten days."
    assert got[1].cards.startswith("### Source Document 1\n\n**Source:** hr.pdf") and got[1].cards.count("### ") == 2
    assert "**Relevance Score:** " in got[1].cards
    assert not got[2].on_topic and got[2].cards == "" and "brand colour" in got[2].answer


def test_all_refused_and_none_refused(spark, chunks):
    for topics, want in (("zebra", False), ("leave", True)):
        queries = spark.createDataFrame([(1, "About leave?", f"Topics: {topics}")], "qid bigint, question string, guard string")
        assert [r.on_topic for r in A.answer_queries(queries, chunks, B.topics_client, k=1).collect()] == [want]


def test_empty_store_gives_the_fixed_sentence(spark, chunks):
    from millrace.operators.retrieval import NO_CONTEXT
    queries = spark.createDataFrame([(1, "Anything?")], "qid bigint, question string")
    row = A.answered(queries, chunks.filter("false"), k=3).first()
    assert row.answer == NO_CONTEXT and row.cards == ""


def test_first_question_is_not_rewritten(spark):
    talk = spark.createDataFrame([(1, 0, "user", "Who? Me"), (2, 0, "user", "What is X?"), (2, 1, "assistant", "A thing."), (2, 2, "user", "And Y? Or")],
                                 "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): r.question for r in A.standalone_questions(talk).collect()}
    assert got == {(1, 0): "Who? Me", (2, 0): "What is X?", (2, 2): "And Y?"}


def test_first_sentences(spark):
    df = spark.createDataFrame([("A. B! C? D.",), ("only this",), ("",)], "t string")
    assert [r[0] for r in df.select(A.first_sentences(F.col("t"), 3)).collect()] == ["A. B! C?", "only this", ""]


def test_product_chain(spark):
    df = spark.createDataFrame([("X1000 has 128 cores. More.",)], "c string")
    row = A.product_replies(df, "c", B.tagging_client("products")).first()
    assert row.details == "X1000 has 128 cores." and row.reply == "X1000 has 128 cores."
    nothing = A.product_replies(df, "c", lambda: (lambda prompts: ["no tags"] * len(prompts))).first()
    assert nothing.details == "No relevant information found!"


def test_embedding_keeps_columns_and_takes_null_as_empty(spark):
    df = spark.createDataFrame([(1, "abc", [1, None]), (2, None, None)], "i long, t string, more array<int>").coalesce(1)
    got = B.embed_with(df, "t", "v", lambda: (lambda texts: np.array([[len(t), np.nan if t else 2.0] for t in texts])))
    assert got.columns == ["i", "t", "more", "v"]
    assert sorted(map(tuple, got.collect())) == [(1, "abc", [1, None], [3.0, None]), (2, None, None, [0.0, 2.0])]
    assert B.embed_with(df.limit(0), "t", "v", lambda: None).count() == 0


def test_digest_embedding_word_by_word(monkeypatch):
    """Many texts at a time, whatever is still known of their words."""
    import hashlib
    import random
    import re

    def slow(text, dims):
        counts = np.zeros(dims)
        for word in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text)):
            if word:
                counts[int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % dims] += 1
        size = np.sqrt((counts * counts).sum())
        return np.floor(1000 * counts / size) if size else counts
    monkeypatch.setattr(B, "_WORDS_KNOWN", 50)
    rng = random.Random(4)
    letters = "abYZ09 .-_`{\x7f\x85\xa0\u00c4\u00e4\u0130\u2028\U0001f600\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2300)]
    assert (B.digest_embedder(16)(texts) == np.array([slow(t, 16) for t in texts])).all()
