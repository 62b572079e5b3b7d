"""Batch inference and retrieval jobs over whole tables, with the offline client."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators import answering as A, batch as B
from millrace.operators.retrieval import NO_CONTEXT
from millrace.operators.sizing import spread
from millrace.plans.registry import query
from millrace.session import load
from millrace.sources.staging import fresh_path, stage

_BLANKS = "concat(' ', chr(9), chr(10), chr(13))"


def _sentence(text: str) -> str:
    """SQL for the offline answer: the first sentence of a context."""
    return f"trim(regexp_extract({text}, '^[^.!?]*[.!?]?'), {_BLANKS})"


@query("llm_batch", f"select item_id, {_sentence('text')} as answer from benchmark")
def llm_batch(spark, d):
    asked = load(spark, d, "benchmark").select("item_id", F.concat(F.lit("Summarize.\n\nContext: "), "text").alias("prompt"))
    return B.complete_logged(asked, "prompt", "answer", fresh_path(spark, "answer-log")).select("item_id", "answer")


TASKS = {"writing": "Write a story. Context: ", "code": "Write a function. Context: ", "summary": "Summarize. Context: "}
MODELS = ["model_a", "model_b", "model_c"]


@query("llm_model_matrix", " union all ".join(
    f"select item_id, '{t}' as task, " + ", ".join(f"concat('[{m}] ', {_sentence('text')}) as {m}" for m in MODELS)
    + " from benchmark" for t in TASKS))
def llm_model_matrix(spark, d):
    tasks = F.array(*[F.struct(F.lit(t).alias("task"), F.lit(p).alias("start")) for t, p in TASKS.items()])
    prompts = load(spark, d, "benchmark").select("item_id", "text", F.explode(tasks).alias("t")).select(
        "item_id", "t.task", F.concat("t.start", "text").alias("prompt")
    )
    return B.model_matrix(prompts, ["item_id", "task"], "prompt", {m: B.named_client(m) for m in MODELS})


@query("join_cross_prompt_model", """
select item_id, model, text as prompt from benchmark, unnest(['model_a', 'model_b', 'model_c']) as m(model)""")
def join_cross_prompt_model(spark, d):
    prompts = load(spark, d, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return B.every_model(prompts, MODELS).select("item_id", "model", "prompt")


@query("llm_prompt_chain", f"""
with f as (select item_id, {_sentence('text')} as details from benchmark)
select item_id, details, {_sentence('details')} as reply from f""")
def llm_prompt_chain(spark, d):
    rows = load(spark, d, "benchmark").select("item_id", "text")
    return A.product_replies(rows, "text", B.tagging_client("products")).select("item_id", "details", "reply")


@query("llm_refusal", f"""
select item_id as qid, {_sentence("concat('Someone asked: \"', text, '\"', chr(10), 'This assistant follows: \"Topics: law\"')")} as answer
from benchmark""")
def llm_refusal(spark, d):
    asked = load(spark, d, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question"), F.lit("Topics: law").alias("guard")
    )
    return A.refused(asked).select("qid", "answer")


# What retrieval does, as SQL: fixed chunks, the digest embedding, squared distances and the first sentence of the context.
_WORDS = ("string_split(trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), ' ')")


def _vectors(name: str, table: str, key: str, text: str) -> str:
    """(key, b, x): the non-zero components of each text's vector."""
    words = _WORDS.format(f"coalesce({text}, '')")
    return f"""{name}_counts as (
  select {key}, ('0x' || left(md5(w), 4))::int % 64 as b, count(*) as c
  from (select {key}, unnest({words}) as w from {table}) where w <> '' group by 1, 2),
{name} as (select {key}, b, floor(1000 * c / sqrt(sum(c * c) over (partition by {key})))::bigint as x from {name}_counts)"""


def _found_sql(questions: str, size: int, stride: int, k: int, may_see: str = "true", rerank: bool = False) -> str:
    """CTEs up to ``context`` (qid, cards, context); ``questions`` is the CTE that gives (qid, question and what may_see needs)."""
    place = "row_number() over (partition by qid order by round(dot / (sqrt(cc::double) * sqrt(qq::double)), 9) desc, id)" if rerank else "rank"
    return f"""{questions},
chunks as (
  select doc_id, lang, doc_id * 1000000 + n as id, substr(text, n * {stride} + 1, {size}) as text
  from documents, unnest(range(0, greatest(coalesce(len(text), 0) - 1, 0) // {stride} + 1)) as r(n)),
{_vectors("cv", "chunks", "id", "text")},
words_asked as (select distinct question from asked),
{_vectors("qv", "words_asked", "question", "question")},
dots as (select question, id, sum(qv.x * cv.x) as dot from qv join cv using (b) group by 1, 2),
pairs as (
  select asked.qid, chunks.id, chunks.text, coalesce(dot, 0) as dot, coalesce(a.n, 0) as qq, coalesce(b.n, 0) as cc
  from asked join chunks on {may_see}
  left join dots on dots.question = asked.question and dots.id = chunks.id
  left join (select question, sum(x * x) as n from qv group by 1) a on a.question = asked.question
  left join (select id, sum(x * x) as n from cv group by 1) b on b.id = chunks.id),
ranked as (select *, row_number() over (partition by qid order by qq + cc - 2 * dot, id) as rank from pairs qualify rank <= {k}),
placed as (select *, {place} as place from ranked),
context as (select qid, count(*) as cards, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by place) as context
  from placed group by 1)"""


_ANSWER = (f"case when context is null then '{NO_CONTEXT}' else " + _sentence(
    "concat(context, chr(10), chr(10), 'Question: ', question, chr(10), 'Answer with citations.')") + " end")


def _refusal(guard: str) -> str:
    return _sentence(f"""concat('Someone asked: "', question, '"', chr(10), 'This assistant follows: "', {guard}, '"', chr(10), 'The question is outside of that.')""")


def _documents(spark, d, *more: str) -> DataFrame:
    return spread(load(spark, d, "documents").select("doc_id", "text", "source", *more))


def _chunk_id():
    return F.col("doc_id") * 1_000_000 + F.col("chunk")


_READERS = "Answer the library\'s readers. Topics: whst, reed"


@query("llm_rag_job", "with " + _found_sql(
    "asked as (select item_id as qid, text as question, contains(lower(text), 'whst') or contains(lower(text), 'reed') as on_topic from benchmark)",
    800, 740, 20, "on_topic", rerank=True) + f"""
select qid, on_topic, case when on_topic then {_ANSWER} else {_refusal("'" + _READERS.replace("'", "''") + "'")} end as answer,
       coalesce(cards, 0) as cards from asked left join context using (qid)""")
def llm_rag_job(spark, d):
    asked = load(spark, d, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question"), F.lit(_READERS).alias("guard")
    )
    chunks = A.indexed(_documents(spark, d), make_vectors=A.by_digest, make_id=_chunk_id())
    done = A.answer_queries(asked, chunks, B.topics_client, k=20, rerank=True, make_vectors=A.by_digest)
    n_cards = F.size(F.split("cards", "### Source Document ")) - 1
    return done.select("qid", "on_topic", "answer", n_cards.cast("bigint").alias("cards"))


@query("llm_history_query", "with " + _found_sql(f"""said as (
  select conv_id, turn, role, text, string_agg(concat(role, ': ', text), chr(10)) over (
    partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as history from conversations),
asked as (
  select concat(conv_id, ':', turn) as qid, conv_id, turn, case when history is null then text
         else {_sentence("concat(text, chr(10), chr(10), 'Conversation:', chr(10), history)")} end as question
  from said where role = 'user')""", 1000, 800, 4) + f""",
answers as (select conv_id, turn, question, {_ANSWER} as answer from asked left join context using (qid))
select conv_id, turn, question, trim(regexp_extract(answer, '^(?:[^.!?]*[.!?]){{1,3}}|^[^.!?]*'), ' ') as answer from answers""")
def llm_history_query(spark, d):
    questions = stage(A.standalone_questions(load(spark, d, "conversations")), "questions")
    chunks = A.indexed(_documents(spark, d), 1000, 200, A.by_digest, _chunk_id())
    done = A.answered(questions.select("qid", "question"), chunks, k=4, make_vectors=A.by_digest)
    return done.join(questions.select("qid", "conv_id", "turn"), "qid").select(
        "conv_id", "turn", "question", A.first_sentences(F.col("answer"), 3).alias("answer"))


# Each department: the topics of its guard, and the languages its assistant may read. Nothing is written for the last one.
_SCOPES = {"HR": ("leave, the, of", ["en"]), "marketing": ("brand, les", ["fr", "es"]), "sales": ("sales, und, ber", ["de", "en"]),
           "legal": ("the, und", ["la"])}


def _guard(scope: str) -> str:
    return f"Answer for {scope}. {B.TOPICS_MARK}{_SCOPES[scope][0]}"


@query("llm_role_scopes", "with " + _found_sql("asked as (" + " union all ".join(
    f"select concat(item_id, '{scope}') as qid, item_id, '{scope}' as scope, '{_guard(scope)}' as guard, text as question, {sees} as sees, "
    + " or ".join(f"contains(lower(text), '{w}')" for w in topics.split(", ")) + " as on_topic from benchmark"
    for scope, (topics, sees) in _SCOPES.items()) + ")", 800, 740, 4, "on_topic and list_contains(sees, lang)") + f"""
select item_id, scope, on_topic, case when on_topic then {_ANSWER} else {_refusal("guard")} end as answer, coalesce(cards, 0) as cards
from asked left join context using (qid)""")
def llm_role_scopes(spark, d):
    asked = load(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    chunks = A.indexed(_documents(spark, d, "lang"), make_vectors=A.by_digest, make_id=_chunk_id(), of="lang")
    scopes_of = {s: (_guard(s), sees) for s, (_, sees) in _SCOPES.items()}
    done = A.answer_scopes(asked, scopes_of, chunks, B.topics_client, k=4, make_vectors=A.by_digest)
    n_cards = F.size(F.split("cards", "### Source Document ")) - 1
    return done.select(F.col("qid").alias("item_id"), "scope", "on_topic", "answer", n_cards.cast("bigint").alias("cards"))
