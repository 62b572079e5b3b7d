"""Vector store: distances, search, filters, maintenance, rerank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.vectors import cosine, embed, squared_l2
from millrace.operators import pivots, retrieval as R, stores as St
from millrace.operators.buckets import BucketStore
from millrace.operators.nearest import compare_all, nearest
from millrace.plans.registry import query
from millrace.operators.sizing import small_side, spread
from millrace.session import load
from millrace.sources.staging import fresh_path, stage

# The queries asked are the mean vectors of the labels, so every stored vector takes part in them.
CENTROID_SQL = """e as (select vec_id, label, pos, embedding[pos]::double as x
  from embeddings, range(1, 65) r(pos)),
q as (select label as qid, pos, avg(x) as m from e group by 1, 2)"""

PAIRS_SQL = CENTROID_SQL + """, p as (
  select q.qid, e.vec_id as id, any_value(e.label) as label, round(sum((e.x - q.m) * (e.x - q.m)), 9) as distance,
         round(1 - sum(e.x * q.m) / (sqrt(sum(e.x * e.x)) * sqrt(sum(q.m * q.m))), 9) as cos
  from e join q using (pos) group by 1, 2)"""


def topk_sql(k: int, where: str = "true") -> str:
    return f"""with {PAIRS_SQL}, ranked as (
  select qid, id, distance, row_number() over (partition by qid order by distance, id) as rank from p where {where})
select qid::bigint as qid, id, round(distance, 6) as distance, rank from ranked where rank <= {k}"""


def corpus(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def label_queries(spark: SparkSession, d: str) -> DataFrame:
    means = R.group_means(corpus(spark, d), "label", "vec")
    return means.select(F.col("label").cast("bigint").alias("qid"), "vec")


def _with_mean(spark, d) -> DataFrame:
    """Every vector beside the mean of its label; one row per label is sent to the vectors."""
    means = stage(R.group_means(corpus(spark, d), "label", "vec").withColumnRenamed("vec", "mean"), "means")
    return corpus(spark, d).join(small_side(means, 10_000), "label")


def shown(found: DataFrame) -> DataFrame:
    return found.withColumn("distance", F.round("distance", 6))


@query("vec_l2", f"""with {PAIRS_SQL}
select id, round(distance, 6) as l2 from p where label = qid""")
def vec_l2(spark, d):
    both = _with_mean(spark, d)
    return both.select("id", F.round(F.round(squared_l2(F.col("vec"), F.col("mean")), 9), 6).alias("l2"))


@query("vec_cosine", f"""with {PAIRS_SQL}
select id, round(1 - cos, 6) as similarity from p where label = qid""")
def vec_cosine(spark, d):
    both = _with_mean(spark, d)
    similarity = 1 - F.round(1 - cosine(F.col("vec"), F.col("mean")), 9)
    return both.select("id", F.round(similarity, 6).alias("similarity"))


@query("join_query_corpus", f"""with {PAIRS_SQL}
select qid::bigint as qid, count(*) as n, round(min(distance), 6) as nearest, round(max(distance), 6) as farthest,
       round(avg(distance), 6) as mean from p group by 1""")
def join_query_corpus(spark, d):
    summary = compare_all(label_queries(spark, d), corpus(spark, d))
    return summary.withColumns({c: F.round(c, 6) for c in ("nearest", "farthest", "mean")})


@query("topk_search_score", topk_sql(2))
def topk_search_score(spark, d):
    return shown(nearest(label_queries(spark, d), corpus(spark, d), 2))


@query("topk_search_filtered", topk_sql(2, "label = 3"))
def topk_search_filtered(spark, d):
    return shown(nearest(label_queries(spark, d), corpus(spark, d).filter("label = 3"), 2))


@query("topk_retrieve", topk_sql(20))
def topk_retrieve(spark, d):
    return shown(nearest(label_queries(spark, d), corpus(spark, d), 20))


@query("topk_search_indexed", topk_sql(20))
def topk_search_indexed(spark, d):
    """The same from an index on disk, of which only pieces are read that may hold one of the nearest."""
    return shown(pivots.search(label_queries(spark, d), pivots.index(corpus(spark, d)), 20))


@query("topk_rerank", f"""with {PAIRS_SQL}, ranked as (
  select qid, id, distance, row_number() over (partition by qid order by distance, id) as rank from p),
c as (select r.*, n_chars as score from ranked r left join documents on doc_id = id where rank <= 20)
select qid::bigint as qid, id, rank, score, row_number() over (partition by qid order by score desc nulls last, id) as place from c""")
def topk_rerank(spark, d):
    found = stage(nearest(label_queries(spark, d), corpus(spark, d), 20), "ranked")
    lengths = load(spark, d, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    # the few found are looked up; one without a document stays, behind those that have one
    known = stage(lengths.join(small_side(found.select("id").distinct()), "id"), "lengths")
    return R.rerank_by_score(found.join(known, "id", "left"), F.col("n_chars")).select("qid", "id", "rank", "score", "place")


@query("flt_metadata_eq", "select vec_id as id, label from embeddings where label = 3")
def flt_metadata_eq(spark, d):
    return corpus(spark, d).filter("label = 3").select("id", "label")


@query("vec_check_dims", """
select vec_id as id, len(embedding) as dims, embedding[1]::double as v1, embedding[2]::double as v2,
       embedding[3]::double as v3 from embeddings""")
def vec_check_dims(spark, d):
    first = [F.col("vec")[i].cast("double").alias(f"v{i + 1}") for i in range(3)]
    return corpus(spark, d).select("id", F.size("vec").cast("bigint").alias("dims"), *first)


@query("vec_label_centroids", f"""with {CENTROID_SQL},
spread as (select qid, avg(dist) as spread from (
  select q.qid, vec_id, sum((x - m) * (x - m)) as dist from e join q on e.pos = q.pos and e.label = q.qid group by 1, 2)
  group by 1),
pairs as (select a.qid, b.qid as other, round(sum((a.m - b.m) * (a.m - b.m)), 9) as distance
  from q a join q b on a.pos = b.pos and a.qid <> b.qid group by 1, 2),
near as (select *, row_number() over (partition by qid order by distance, other) as rn from pairs)
select near.qid::bigint as qid, other::bigint as other, round(distance, 6) as distance, round(spread, 6) as spread
from near join spread using (qid) where rn = 1""")
def vec_label_centroids(spark, d):
    means = stage(label_queries(spark, d), "means")
    others = (
        nearest(means, means.select(F.col("qid").alias("id"), "vec"), 2)
        .filter("id <> qid").groupBy("qid").agg(F.min_by("id", "rank").alias("other"), F.min("distance").alias("distance"))
    )
    own = small_side(means.select(F.col("qid").alias("label"), F.col("vec").alias("mean")), 10_000)
    store = corpus(spark, d).join(own, "label")
    spread = store.groupBy(F.col("label").cast("bigint").alias("qid")).agg(
        F.avg(squared_l2(F.col("vec"), F.col("mean"))).alias("spread")
    )
    return others.join(spread, "qid").withColumns({c: F.round(c, 6) for c in ("distance", "spread")})


def _toxic_ids(spark, d) -> DataFrame:
    return load(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))


@query("join_semi_get_ids", """
select vec_id as id, label from embeddings where vec_id in (select doc_id from labels where toxic = 1)""")
def join_semi_get_ids(spark, d):
    return St.get_documents(corpus(spark, d).select("id", "label"), _toxic_ids(spark, d), "id")


@query("join_anti_delete_ids", """
select vec_id as id, label from embeddings where vec_id not in (select doc_id from labels where toxic = 1)""")
def join_anti_delete_ids(spark, d):
    return St.delete_documents(corpus(spark, d).select("id", "label"), _toxic_ids(spark, d), "id")


def _store(documents: DataFrame, key: str) -> BucketStore:
    """A store of these documents on disk, in buckets of ids."""
    spark = documents.sparkSession
    store = BucketStore(spark, fresh_path(spark, "store"), documents.schema, key, 16)
    store.create(documents)
    return store


@query("dml_delete_document", """
select label::varchar as collection, count(*) as vectors from embeddings
where vec_id not in (select doc_id from labels where toxic = 1) group by 1""")
def dml_delete_document(spark, d):
    store = corpus(spark, d).select("id", F.col("label").cast("string").alias("collection"))
    kept = _store(store, "id")
    kept.delete(_toxic_ids(spark, d))
    return kept.read().groupBy("collection").agg(F.count("*").alias("vectors"))


@query("dml_add_documents", """
with store as (select doc_id::varchar as id, text, 1 as version from documents),
a as (select doc_id::varchar as id, concat(text, ' (revised)') as text, 2 as version from documents where lang = 'fr'
      union all select md5(text) as id, min(text) as text, 2 as version from benchmark group by 1)
select id, version, md5(text) as digest from a
union all select id, version, md5(text) from store where id not in (select id from a)""")
def dml_add_documents(spark, d):
    docs = load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "lang")
    store = docs.select("id", "text", F.lit(1).alias("version"))
    again = docs.filter("lang = 'fr'").select("id", F.concat("text", F.lit(" (revised)")).alias("text"), F.lit(2).alias("version"))
    fresh = load(spark, d, "benchmark").select(St.text_id(F.col("text")).alias("id"), "text", F.lit(2).alias("version"))
    kept = _store(store, "id")
    kept.add(again.unionByName(St.newest(fresh, "id", "version")))
    return kept.read().select("id", "version", F.md5("text").alias("digest"))


@query("dml_update_document", """
select doc_id, case when quality = 1 then 'news' else source end as source,
       md5(case when quality = 1 then concat('Updated: ', text) else text end) as digest
from documents left join labels using (doc_id)""")
def dml_update_document(spark, d):
    store = load(spark, d, "documents").select("doc_id", "text", "source")
    good = load(spark, d, "labels").filter("quality = 1").select("doc_id")
    changes = St.get_documents(store, good, "doc_id").select(
        "doc_id", F.concat(F.lit("Updated: "), "text").alias("text"), F.lit("news").alias("source")
    )
    kept = _store(store, "doc_id")
    kept.update(changes)
    return kept.read().select("doc_id", "source", F.md5("text").alias("digest"))


def _squared_norm():
    return F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), 4).alias("norm")


# A text with any word has a vector of unit length, another one all zeros.
_NORM_SQL = "case when regexp_matches(text, '[\\p{L}\\p{N}_]') then 1.0 else 0.0 end::double"


@query("vec_store_build", f"""
select doc_id as id, lang as collection, source, 256::bigint as dims, {_NORM_SQL} as norm from documents""")
def vec_store_build(spark, d):
    docs = spread(load(spark, d, "documents")).select(
        F.col("doc_id").alias("id"), "text", F.create_map(F.lit("source"), F.col("source")).alias("meta"),
        F.col("lang").alias("collection"),
    )
    path = St.save_store(embed(docs, "text"), "vectors")
    stored = spark.read.parquet(path)
    return stored.select(
        "id", "collection", F.col("meta")["source"].alias("source"), F.size("vec").cast("bigint").alias("dims"),
        _squared_norm(),
    )


@query("vec_embed", f"select doc_id, 256::bigint as dims, {_NORM_SQL} as norm from documents")
def vec_embed(spark, d):
    docs = embed(spread(load(spark, d, "documents")).select("doc_id", "text"), "text")
    return docs.select(
        "doc_id", F.size("vec").cast("bigint").alias("dims"), _squared_norm(),
    )


_RERANK_SQL = """c as (
  select source as query_id, row_number() over (partition by source order by n_chars desc, doc_id) - 1 as position,
         doc_id, source, n_chars from documents),
k as (select * from c where position < 20),
r as (select query_id, position as seq,
        case when position % 9 = 4 then null else ((position * 7) % 23) - 2 end as idx,
        case when position % 3 = 0 then null else n_chars / 10.0 end as logit, position / 4.0 as score from k)"""


@query("join_rerank_index", f"""with {_RERANK_SQL}
select r.query_id, r.seq, k.position, k.doc_id, k.source, round(coalesce(r.logit, r.score), 4)::double as relevance_score
from r join k on r.query_id = k.query_id and r.idx = k.position where r.idx >= 0""")
def join_rerank_index(spark, d):
    from pyspark.sql import Window as W
    order = W.partitionBy("source").orderBy(F.col("n_chars").desc(), "doc_id")
    docs = load(spark, d, "documents").select("doc_id", "source", "n_chars")
    top = docs.withColumn("rn", F.row_number().over(order)).filter("rn <= 20").select(
        F.col("source").alias("query_id"), (F.col("rn") - 1).cast("bigint").alias("position"), "doc_id", "source", "n_chars"
    )
    rankings = top.selectExpr(
        "query_id", "position as seq",
        "case when position % 9 = 4 then null else ((position * 7) % 23) - 2 end as index",
        "case when position % 3 = 0 then null else n_chars / 10.0D end as logit", "position / 4.0D as score",
    )
    ranked = R.apply_rankings(top.drop("n_chars"), rankings)
    return ranked.withColumn("relevance_score", F.round("relevance_score", 4))
