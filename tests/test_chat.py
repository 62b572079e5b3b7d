"""Conversations against brute force; one of them holds most messages and spans many blocks."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import answering as A, chat as C


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(5)
    out = {}
    for conv, n in [(1, 60), (2, 9), (3, 1), (4, 2), (5, 30)]:
        turn, rows = 0, []
        for _ in range(n):
            turn += rnd.choice([1, 1, 1, 5])  # turns may skip numbers
            rows.append((conv, turn, rnd.choice(["user", "assistant", "assistant"]), "t" * rnd.randint(1, 9)))
        out[conv] = rows
    out[5][20] = (5, out[5][20][1], "assistant", "done TERMINATE")
    return out


@pytest.fixture
def table(spark, talks, monkeypatch):
    monkeypatch.setattr(C, "TURNS_PER_BLOCK", 4)
    return spark.createDataFrame([r for rows in talks.values() for r in rows], "conv_id bigint, turn bigint, role string, text string")


def test_prior_turns(table, talks):
    got = {(r.conv_id, r.turn): (r.prior_messages, r.prior_chars, r.prior_user) for r in C.prior_turns(table).collect()}
    for conv, rows in talks.items():
        for i, (_, turn, _, _) in enumerate(rows):
            before = rows[:i]
            assert got[conv, turn] == (i, sum(len(r[3]) for r in before), sum(r[2] == "user" for r in before))


def test_last_messages(table, talks):
    got = {(r.conv_id, r.turn): (r.looked_at, r.last_text) for r in C.last_messages(table, 3).collect()}
    for conv, rows in talks.items():
        for i, (_, turn, _, _) in enumerate(rows):
            before = rows[max(0, i - 3):i]
            assert got[conv, turn] == (len(before), "\n".join(f"{r[2]}: {r[3]}" for r in before))


def test_limits(table, talks):
    assert C.first_turns(table, 8).groupBy("conv_id").count().agg(F.max("count")).first()[0] == 8
    kept = {(r.conv_id, r.turn) for r in C.exchanges(table, 2).collect()}
    for conv, rows in talks.items():
        for i, (_, turn, _, _) in enumerate(rows):
            assert ((conv, turn) in kept) == (sum(r[2] == "user" for r in rows[:i + 1]) <= 2)


@pytest.mark.parametrize("most", [0, 1, 3, 100])
def test_until_terminate(table, talks, most):
    kept = {(r.conv_id, r.turn) for r in C.until_terminate(table, F.col("role") == "assistant", most_in_a_row=most).collect()}
    want = set()
    for conv, rows in talks.items():
        run = 0
        for _, turn, role, text in rows:
            run = run + 1 if role == "assistant" else 0
            if run > most:
                break
            want.add((conv, turn))
            if "TERMINATE" in text:
                break
    assert kept == want


def test_history_word_for_word(table, talks):
    got = {(r.conv_id, r.turn): r.history for r in A.with_histories(table).collect()}
    want = {}
    for conv, rows in talks.items():
        for i, (_, turn, role, _) in enumerate(rows):
            if role == "user":
                want[conv, turn] = "\n".join(f"{r[2]}: {r[3]}" for r in rows[:i]) if i else None
    assert got == want


def test_long_history_stays_whole(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"message {t} " + "x" * 50) for t in range(401)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    last = A.with_histories(table).filter("turn = 400").first().history
    assert last.split("\n") == [f"{r[2]}: {r[3]}" for r in rows[:400]]
