"""Ranks, probabilities, sampling rules and data splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators import sampling as S, splits
from millrace.plans.registry import query
from millrace.operators.sizing import spread
from millrace.session import load

_SCORES_SQL = "sc as (select label as context, vec_id as candidate, embedding[1]::double as score from embeddings)"
_SOFT_SQL = _SCORES_SQL + """, ex as (
  select *, exp(score - max(score) over (partition by context)) as e from sc),
pr as (select context, candidate, score, e / sum(e) over (partition by context) as p from ex)"""


def scores(spark, d) -> DataFrame:
    return load(spark, d, "embeddings").select(
        F.col("label").alias("context"), F.col("vec_id").alias("candidate"), F.col("embedding")[0].cast("double").alias("score")
    )


@query("rank_candidates", f"""with {_SCORES_SQL}
select context, candidate, row_number() over (partition by context order by score desc, candidate) as rank from sc""")
def rank_candidates(spark, d):
    return S.ranked(scores(spark, d), "context", "candidate", "score").select("context", "candidate", "rank")


@query("win_softmax", f"with {_SOFT_SQL} select context, candidate, round(p, 8) as p from pr")
def win_softmax(spark, d):
    return S.softmax(scores(spark, d), "context", "score").select("context", "candidate", F.round("p", 8).alias("p"))


@query("win_topk_sampling", f"""with {_SOFT_SQL}, k as (
  select *, row_number() over (partition by context order by p desc, candidate) as rn from pr)
select context, candidate, round(p / sum(p) over (partition by context), 8) as p from k where rn <= 50""")
def win_topk_sampling(spark, d):
    kept = S.top_k(S.softmax(scores(spark, d), "context", "score"), "context", "candidate", 50)
    return kept.select("context", "candidate", F.round("p", 8).alias("p"))


@query("win_nucleus", f"""with {_SOFT_SQL}, c as (
  select *, sum(p) over (partition by context order by p desc, candidate rows unbounded preceding) as upto from pr)
select context, candidate, round(p, 8) as p from c where round(upto - p, 9) < 0.85""")
def win_nucleus(spark, d):
    kept = S.nucleus(S.softmax(scores(spark, d), "context", "score"), "context", "candidate", 0.85)
    return kept.select("context", "candidate", F.round("p", 8).alias("p"))


_BIGRAM_SQL = """ws as (select doc_id, regexp_extract_all(text, '[^ \\t\\n\\r]+') as w from documents),
bg as (select doc_id, w[i] as a, w[i + 1] as b from ws, unnest(range(1, len(w))) r(i))"""


@query("win_greedy_next", f"""with {_BIGRAM_SQL}, n as (select a, b, count(*) as n from bg group by 1, 2),
r as (select *, row_number() over (partition by a order by n desc, b) as rn from n)
select a as word, b as next_word, n from r where rn = 1""")
def win_greedy_next(spark, d):
    return S.greedy_next(spread(load(spark, d, "documents").select("text")), "text")


@query("txt_repeated_bigrams", f"""with {_BIGRAM_SQL},
n as (select doc_id, a, b, count(*) as n from bg group by all having count(*) > 1)
select doc_id, count(*) as repeated, sum(n - 1)::bigint as extra from n group by 1""")
def txt_repeated_bigrams(spark, d):
    return S.repeated_bigrams(spread(load(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")


@query("split_70_15_15", """
with c as (select doc_id from documents where lang = 'en' order by doc_id limit 3000),
r as (select doc_id, row_number() over (order by md5(concat('1234:', doc_id::varchar)), doc_id) as place from c),
n as (select least(1500, count(*)) as n from c)
select doc_id, case when place <= floor(0.70 * n) then 'training'
  when place <= floor(0.70 * n) + floor(0.15 * n) then 'validation' else 'testing' end as split
from r, n where place <= n""")
def split_70_15_15(spark, d):
    usable = load(spark, d, "documents").filter("lang = 'en'").select("doc_id")
    return splits.draw_and_split(usable, "doc_id").select("doc_id", "split")


@query("txt_length_bucket", """
with r as (select doc_id, length(text) as chars, (row_number() over (order by length(text), doc_id) - 1) // 4 as batch from documents)
select batch, count(*) as docs, max(chars)::bigint as longest, (max(chars) * count(*) - sum(chars))::bigint as padding
from r group by 1""")
def txt_length_bucket(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.length("text").cast("bigint").alias("chars"))
    return splits.length_batches(docs, "doc_id", "chars", 4)


@query("txt_packing", """
with r as (select doc_id, length(text) as chars,
             sum(length(text)) over (order by doc_id rows unbounded preceding) - length(text) as start from documents)
select doc_id, (start // 2048)::bigint as first_sequence, ((start + chars - 1) // 2048)::bigint as last_sequence,
       (start % 2048)::bigint as at from r where chars > 0""")
def txt_packing(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.length("text").cast("bigint").alias("chars"))
    return splits.packed(docs, "doc_id", "chars", 2048)
