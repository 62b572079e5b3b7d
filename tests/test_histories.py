"""Long conversations: shared blocks, and prompts that stream past the questions of a block."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import answering as A, batch as B, chat as C


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(4)
    talk = {c: [(t * 3, rng.choice(["user", "user", "assistant", None]), rng.choice(["One. Two", "why", "", None, f"text {t}!"]))
                for t in range(n)] for c, n in [(1, 1), (2, 5), (3, 90), (None, 11), (9, 8)]}
    return talk


@pytest.fixture(scope="module")
def table(spark, talks):
    rows = [(c, t, r, x) for c, ms in talks.items() for t, r, x in ms]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)


def wanted(talks):
    return {(c, t): ("\n".join(f"{r or ''}: {x or ''}" for _, r, x in ms[:i]) if i else None)
            for c, ms in talks.items() for i, (t, role, _) in enumerate(ms) if role == "user"}


@pytest.mark.parametrize("block", [1, 4, 256])
def test_histories_word_for_word(table, talks, block):
    got = A.with_histories(table, block).collect()
    assert {(r.conv_id, r.turn): r.history for r in got} == wanted(talks) and len(got) == len(wanted(talks))


@pytest.mark.parametrize("block", [3, 256])
def test_streamed_answers_are_those_of_whole_prompts(table, block):
    streamed = sorted(map(tuple, A.standalone_questions(table, block=block).collect()), key=str)
    whole = sorted(map(tuple, A.standalone_questions(table, B.extractive_client, block).collect()), key=str)
    assert streamed == whole


def test_blocks_and_a_tail_expand_to_the_history(table, talks):
    numbered = C.placed(table, 4)
    referred = C.histories(numbered, F.col("role") == "user")
    assert referred.count() == len(wanted(talks))
    got = {}
    for r in C.expanded(numbered, referred).collect():
        got.setdefault((r.conv_id, r.ask_turn), []).append((r.place, f"{r.role or ''}: {r.text or ''}"))
    assert {k: "\n".join(x for _, x in sorted(v)) for k, v in got.items()} == {k: v for k, v in wanted(talks).items() if v is not None}


def test_a_long_conversation_is_spread_and_its_rows_are_counted_by_blocks(spark):
    n, block = 1200, 30
    rows = [(1, t, "user" if t % 2 else "assistant", f"m{t}") for t in range(n)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")

    class Counting(B.Streaming):
        """Says how many pieces of a prompt were fed, and in which task."""
        def begin(self):
            return [0]

        def feed(self, prompt, text):
            prompt[0] += 1
            return True

        def finish(self, prompts):
            from pyspark import TaskContext
            for prompt in prompts:
                yield f"{prompt[0]} {TaskContext.get().partitionId()}"
    said = A.ask_with_histories(table, Counting, lambda q: q, block=block).collect()
    fed = {r.turn: int(r.said.split()[0]) for r in said}
    assert fed == {t: t + 1 for t in range(1, n, 2)}  # the head, and every earlier message once
    assert len({r.said.split()[1] for r in said}) > 1


def test_a_block_holds_its_own_messages_only():
    block = A._Block(B.Streaming(), lambda q: B.CONTEXT_MARK + q)
    block.own = [(300, 300, True, "what. more", "user: what. more"), (301, 301, True, "and", "user: and")]
    for n in range(100_000):
        block.earlier(f"line {n}" + "." * (n > 50_000))
    assert [r[3] for r in block.answers("")] == ["what.", "and" + "\n".join(f"line {n}" for n in range(50_002)) + "."]
    # the first prompt had its answer before any line
    assert len(block.own) == 2 and block.lines == 100_000


def test_streaming_reads_like_the_whole(spark):
    rng = random.Random(9)
    whole = B.extractive_client()
    model = B.Streaming()
    for _ in range(500):
        text = "".join(rng.choice(["Con", "text: ", "Context: ", "a b", ".", "!", "\n", "Context:", " "]) for _ in range(rng.randint(0, 12)))
        prompt, at = model.begin(), 0
        while at < len(text):
            n = rng.randint(1, 4)
            model.feed(prompt, text[at:at + n])
            at += n
        assert list(model.finish([prompt])) == whole([text])
