"""Questions answered from documents: guard, retrieve, rerank, answer, cite."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import on_topic, render, section
from millrace.functions.vectors import cosine, embed
from millrace.operators import batch as B, chat as C, retrieval as R
from millrace.operators.chunks import fixed_chunks
from millrace.operators.nearest import nearest
from millrace.operators.sizing import small_side
from millrace.sources.staging import fresh_path, stage, write_by

GUARD = "{{guard}}\nQuestion: {{question}}"
REFUSAL_CASE = 'Someone asked: "{{question}}"\nThis assistant follows: "{{guard}}"\nThe question is outside of that.'
REFUSAL = "Explain briefly and politely why a question is refused.\n\n" + B.CONTEXT_MARK + REFUSAL_CASE
ANSWER = "Answer only from the context and cite it.\n\n" + B.CONTEXT_MARK + "{{context}}\n\nQuestion: {{question}}\nAnswer with citations."
STANDALONE = (
    "Rewrite the question so that it can be understood without the conversation.\n\n"
    + B.CONTEXT_MARK + "{{question}}\n\nConversation:\n{{history}}"
)

Embed = Callable[[DataFrame, str, str], DataFrame]


def by_digest(df: DataFrame, text: str, out: str) -> DataFrame:
    """Vectors that SQL can compute too, see ``digest_embedder``."""
    return B.embed_with(df, text, out, B.digest_embedder)


def indexed(
    docs: DataFrame, size: int = 800, overlap: int = 60, make_vectors: Embed = embed, make_id: Column | None = None,
    of: str | None = None,
) -> DataFrame:
    """(id, doc_id, source, page, text, vec): chunks of documents with their vectors, staged once.

    ``make_id`` tells the id from doc_id and chunk (from 0), else it is a hash of them. ``of`` names a column of ``docs`` that says who
    may see a document; it becomes the column ``of`` of the store, which has a folder for each of its (few) values.
    """
    cut = fixed_chunks(docs, "doc_id", "text", size, size - overlap, keep=["source", *([of] if of else [])])
    named = cut.select(
        (F.xxhash64("doc_id", "chunk") if make_id is None else make_id.cast("bigint")).alias("id"), "doc_id", "source",
        (F.col("chunk") + 1).alias("page"), "text", *([F.col(of).cast("string").alias("of")] if of else []),
    )
    vectors = make_vectors(named, "text", "vec")
    if not of:
        return stage(vectors, "chunks")
    path = fresh_path(docs.sparkSession, "chunks")
    write_by(vectors, "of", path)
    return docs.sparkSession.read.schema(vectors.schema).parquet(path)


def guarded(queries: DataFrame, make_client: B.MakeClient) -> DataFrame:
    """Adds ``on_topic``; queries are (qid, question, guard). Staged, as both branches read it."""
    asked = queries.withColumn("_p", render(GUARD, {"guard": F.col("guard"), "question": F.col("question")}))
    said = B.complete(asked, "_p", "_said", make_client)
    return stage(
        said.withColumn("on_topic", on_topic(F.col("_said"), F.col("guard"))).drop("_p", "_said"), "guarded"
    )


def refused(queries: DataFrame, make_client: B.MakeClient = B.extractive_client) -> DataFrame:
    """Adds ``answer``: why each question is refused."""
    asked = queries.withColumn("_p", render(REFUSAL, {"guard": F.col("guard"), "question": F.col("question")}))
    return B.complete(asked, "_p", "answer", make_client).drop("_p")


def found_chunks(
    queries: DataFrame, chunks: DataFrame, k: int = 20, rerank: bool = False, make_vectors: Embed = embed
) -> DataFrame:
    """(qid, id, rank, source, page, text, relevance_score) of the k chunks closest to each question.

    Where questions carry a set of values (``sees``), each is answered from the chunks whose ``of`` is among them.
    """
    scoped = "sees" in queries.columns
    vectors = stage(make_vectors(queries.select("qid", "question"), "question", "vec").select("qid", "vec"), "question-vectors")
    if scoped:
        found = nearest(vectors.join(queries.select("qid", "sees"), "qid"), chunks.select("id", "vec", "of"), k, scoped=True)
    else:
        found = nearest(vectors, chunks.select("id", "vec"), k)
    found = stage(found, "ranked")
    # k rows per query go to the chunks, so that the corpus is not shuffled for a few texts.
    rows = chunks.join(small_side(found), "id").join(vectors.withColumnRenamed("vec", "_q"), "qid")
    scored = rows.withColumn("relevance_score", cosine(F.col("vec"), F.col("_q")))
    if not rerank:
        return scored.withColumn("relevance_score", F.lit(None).cast("double")).drop("vec", "_q", "distance")
    placed = R.rerank_by_score(scored, F.round("relevance_score", 9))
    return placed.withColumn("rank", F.col("place")).drop("vec", "_q", "distance", "place", "score")


def cards(found: DataFrame) -> DataFrame:
    """(qid, cards): the source cards of each query in rank order."""
    card = R.source_card(
        F.col("rank"), F.col("text"), F.col("source"), F.lit(None).cast("string"), F.col("page"), F.col("relevance_score")
    )
    listed = found.select("qid", F.struct("rank", card.alias("card")).alias("c")).groupBy("qid").agg(
        F.array_sort(F.collect_list("c")).alias("_c")
    )
    return listed.select("qid", F.array_join(F.transform("_c", lambda c: c["card"]), "").alias("cards"))


def answered(
    queries: DataFrame, chunks: DataFrame, k: int = 20, rerank: bool = False,
    make_client: B.MakeClient = B.extractive_client, make_vectors: Embed = embed,
) -> DataFrame:
    """Adds ``answer`` and ``cards`` to (qid, question): retrieve, maybe rerank, stuff, ask, cite."""
    queries = stage(queries, "asked")
    found = stage(found_chunks(queries, chunks, k, rerank, make_vectors), "found")
    stuffed = R.stuffed_context(queries, found.select("qid", "rank", "id", "text"))
    asked = stuffed.withColumn("_p", render(ANSWER, {"context": F.col("context"), "question": F.col("question")}))
    # Nothing found means the fixed sentence, without asking the model.
    nothing = F.col("context") == R.NO_CONTEXT
    said = B.complete(asked.filter(~nothing), "_p", "answer", make_client).unionByName(
        asked.filter(nothing).withColumn("answer", F.lit(R.NO_CONTEXT))
    )
    return said.drop("_p", "context").join(cards(found), "qid", "left").withColumn("cards", F.coalesce("cards", F.lit("")))


def answer_queries(
    queries: DataFrame, chunks: DataFrame, guard_client: B.MakeClient, k: int = 20, rerank: bool = False,
    make_client: B.MakeClient = B.extractive_client, make_vectors: Embed = embed, keep: list[str] = (),
) -> DataFrame:
    """(qid, question, kept columns, on_topic, answer, cards): off-topic questions are refused without retrieval."""
    checked = guarded(queries, guard_client)
    off = refused(checked.filter(~F.col("on_topic")), make_client).withColumn("cards", F.lit(""))
    on = answered(checked.filter("on_topic"), chunks, k, rerank, make_client, make_vectors)
    columns = ["qid", "question", *keep, "on_topic", "answer", "cards"]
    return on.select(*columns).unionByName(off.select(*columns))


# Characters of text that leave a task in one batch, one row at least.
BATCH_CHARS = 1 << 23


def ask_with_histories(
    messages: DataFrame, make_model: B.MakeStreaming, head: Callable[[str], str], tail: str = "", block: int = C.BLOCK
) -> DataFrame:
    """(conv_id, turn, text, said): every user message, and what the model says to it with all that was said before.

    A prompt is ``head`` of the message's text, the history as lines ``role: text``, oldest first and word for word, and ``tail``. The first
    message of a conversation is not sent: ``said`` is null.

    A conversation is cut into blocks of messages, and each block's questions are asked together, by one task: their prompts are
    opened, all earlier messages run past them once, in order, and then the block's own. Earlier messages are read from the
    shuffle as they are needed. A task thus holds one block, and no history, unless the model collects its prompts. What is sent grows with
    the square of a conversation, as in any chat that repeats its history; what is shuffled, with the square of its blocks.
    """
    numbered = C.placed(messages, block)
    last = numbered.filter((F.col("role") == "user") & (F.col("block") > 0)).groupBy("conv_id").agg(F.max("block").alias("last"))
    columns = ["conv_id", "target", "earlier", "place", "turn", "role", "text"]
    own = numbered.select("*", F.col("block").alias("target"), F.lit(False).alias("earlier")).select(*columns)
    last = last.withColumnRenamed("conv_id", "_conv")
    before = numbered.join(last, F.col("conv_id").eqNullSafe(F.col("_conv"))).filter(F.col("block") < F.col("last")).select(
        "*", F.explode(F.sequence(F.col("block") + 1, "last")).alias("target"), F.lit(True).alias("earlier")).select(*columns)
    # Asking costs far more than moving the rows, so small partitions are not put together: their number is given.
    tasks = max(int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")), messages.sparkSession.sparkContext.defaultParallelism)
    laid = own.union(before).repartition(tasks, "conv_id", "target").sortWithinPartitions("conv_id", "target", "earlier", "place")
    return laid.mapInArrow(_asking(make_model, head, tail), "conv_id bigint, turn bigint, text string, said string")


def _asking(make_model: B.MakeStreaming, head: Callable[[str], str], tail: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        out, size = [], 0
        for row in _block_by_block(batches, model, head, tail):
            out.append(row)
            size += sum(len(x or "") for x in row[2:])
            if size > BATCH_CHARS:
                yield _asks(out)
                out, size = [], 0
        if out:
            yield _asks(out)
    return run


def _block_by_block(batches: Iterator[pa.RecordBatch], model: B.Streaming, head: Callable[[str], str], tail: str) -> Iterator[tuple]:
    at, block = None, None
    for batch in batches:
        for conv_id, target, earlier, place, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv_id, target) != at:
                if block:
                    yield from block.answers(tail)
                at, block = (conv_id, target), _Block(model, head)
            line = f"{role or ''}: {text or ''}"
            if earlier:
                block.earlier(line)
            else:
                block.own.append((place, turn, role == "user", text, line))
            # the next row of another block closes this one; rows of a block are its own, then all earlier ones
            block.conv_id = conv_id
    if block:
        yield from block.answers(tail)


class _Block:
    """The questions of one block, while the earlier messages run past them."""

    def __init__(self, model: B.Streaming, head: Callable[[str], str]):
        self.model, self.head, self.conv_id = model, head, None
        self.own: list[tuple] = []
        self.prompts: list | None = None
        self.open: list = []
        self.lines = 0

    def _begin(self) -> None:
        self.prompts = []
        for place, _, asks, text, _ in self.own:
            if asks and place:
                prompt = self.model.begin()
                if self.model.feed(prompt, self.head(text or "")):
                    self.open.append(prompt)
                self.prompts.append(prompt)

    def earlier(self, line: str) -> None:
        if self.prompts is None:
            self._begin()
        piece = "\n" + line if self.lines else line
        self.lines += 1
        self.open = [p for p in self.open if self.model.feed(p, piece)]

    def answers(self, tail: str) -> Iterator[tuple]:
        if self.prompts is None:
            self._begin()
        waiting = iter(self.prompts)
        asked = [(row, next(waiting) if row[0] else None) for row in self.own if row[2]]
        for (place, *_), prompt in asked:
            wanted = prompt is not None and any(p is prompt for p in self.open)
            for n, (at, *_, line) in enumerate(self.own):
                if not wanted or at >= place:
                    break
                wanted = self.model.feed(prompt, "\n" + line if self.lines + n else line)
            if wanted and tail:
                self.model.feed(prompt, tail)
        said = self.model.finish(self.prompts)
        for (_, turn, _, text, _), prompt in asked:
            yield self.conv_id, turn, text, None if prompt is None else next(said)


def _asks(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["conv_id", "turn", "text", "said"])


def with_histories(messages: DataFrame, block: int = C.BLOCK) -> DataFrame:
    """(conv_id, turn, text, history): every user message with all that was said before it, oldest first, in one string each.

    A history is null for the first message. For readers that need the text; a model is better asked by ``ask_with_histories``.
    """
    return ask_with_histories(messages, B.Collecting, lambda _: "", block=block).withColumnRenamed("said", "history")


def standalone_questions(messages: DataFrame, make_client: B.MakeClient | None = None, block: int = C.BLOCK) -> DataFrame:
    """(qid, conv_id, turn, asked, question): every question, rewritten where it has a history.

    The first message of a conversation is its own stand-alone question and is not sent anywhere. Without a client the
    offline model reads its prompts as they stream; a client gets them in one string each.
    """
    make_model = B.Streaming if make_client is None else lambda: B.Collecting(make_client())
    begin, rest = STANDALONE.split("{{question}}")
    between, tail = rest.split("{{history}}")
    said = ask_with_histories(messages, make_model, lambda question: begin + question + between, tail, block)
    return said.select(
        F.xxhash64("conv_id", "turn").alias("qid"), "conv_id", "turn", F.col("text").alias("asked"),
        F.when(F.col("said").isNull(), F.col("text")).otherwise(_stripped(F.col("said"))).alias("question"),
    )


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def scopes(queries: DataFrame, guards: dict[str, str]) -> DataFrame:
    """Every question under every department's guard: one row per (question, scope)."""
    offered = F.array(*[F.struct(F.lit(s).alias("scope"), F.lit(g).alias("guard")) for s, g in guards.items()])
    return queries.withColumn("_s", F.explode(offered)).select("*", "_s.scope", "_s.guard").drop("_s")


def answer_scopes(
    queries: DataFrame, scopes_of: dict[str, tuple[str, list[str]]], chunks: DataFrame, guard_client: B.MakeClient, k: int = 20,
    rerank: bool = False, make_client: B.MakeClient = B.extractive_client, make_vectors: Embed = embed,
) -> DataFrame:
    """(qid, question, scope, on_topic, answer, cards): an answer or a refusal for every question and scope.

    ``scopes_of`` gives each scope its guard prompt and the values of ``of`` it may see. A refusal is the guard's; what a scope
    may see is decided by the store's metadata, whatever the guard has said. One scan of the store serves all scopes.
    """
    offered = F.array(*[F.struct(F.lit(s).alias("scope"), F.lit(g).alias("guard"), F.array(*map(F.lit, sees)).cast("array<string>").alias("sees"))
                        for s, (g, sees) in scopes_of.items()])
    asked = queries.select(F.col("qid").alias("_q"), "question", F.explode(offered).alias("_s")).select(
        F.xxhash64("_q", "_s.scope").alias("qid"), "_q", "question", "_s.*")
    done = answer_queries(asked, chunks, guard_client, k, rerank, make_client, make_vectors, keep=["_q", "scope"])
    return done.select(F.col("_q").alias("qid"), "question", "scope", "on_topic", "answer", "cards")


EXTRACT = (
    "List what the text below says about compute power, scalability and storage within <products></products> tags, "
    'or say "No relevant information found!".\n\n' + B.CONTEXT_MARK + "{{catalog}}"
)
REPLY = "Write a friendly reply from these products.\n\n" + B.CONTEXT_MARK + "{{details}}"


def product_replies(
    catalogs: DataFrame, text: str, extract_client: B.MakeClient, make_client: B.MakeClient = B.extractive_client
) -> DataFrame:
    """Adds ``details`` and ``reply``: the second prompt is built from the first one's answer."""
    first = B.complete(catalogs.withColumn("_p", render(EXTRACT, {"catalog": F.col(text)})), "_p", "_found", extract_client)
    detailed = first.withColumn("details", section(F.col("_found"), "products"))
    second = detailed.withColumn("_p", render(REPLY, {"details": F.col("details")}))
    return B.complete(second, "_p", "reply", make_client).drop("_p", "_found")


def first_sentences(text: Column, n: int = 3) -> Column:
    """The first n sentences of a text."""
    return F.trim(F.regexp_extract(text, f"^(?:[^.!?]*[.!?]){{1,{n}}}|^[^.!?]*", 0))
