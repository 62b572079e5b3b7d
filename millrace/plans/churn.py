"""The churn path: raw events, curation, features, labels, model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import curate as C, features as X, learning as L
from millrace.operators.sizing import dealt
from millrace.plans.registry import query
from millrace.plans.standins import (
    CURATED_SQL, CUTOFF, DEDUP_SQL, SUBS_SQL, TRAINING_SQL, USAGE_SQL, WATCH_SQL,
    doubled_events, subscribers, watch_events,
)
from millrace.session import load
from millrace.sources import readers
from millrace.sources.staging import fresh_path, stage


def day_text(column: str = "dt"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def raw_folder(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "raw")
    C.write_raw(watch_events(spark, d), path)
    return path


def curated_folder(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "curated")
    C.write_curated(C.curate(doubled_events(spark, d), "smallest"), path)
    return path


def training_table(spark: SparkSession, d: str) -> DataFrame:
    recent = C.recent_days(watch_events(spark, d), CUTOFF)
    return X.attach_usage(subscribers(spark, d), recent.transform(X.squash))


@query("src_csv_events", f"""with {WATCH_SQL}
select event_id, subscriber_id, content_id, strftime(event_date, '%Y-%m-%d') as event_date,
       watch_minutes, device, completed, strftime(dt, '%Y-%m-%d') as dt from w""")
def src_csv_events(spark, d):
    raw = C.read_raw(spark, raw_folder(spark, d))
    return raw.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("event_date", "dt")})


@query("src_partition_day", f"""with {WATCH_SQL}
select strftime(dt, '%Y-%m-%d') as dt, count(*) as rows, count(distinct event_id) as events from w group by 1""")
def src_partition_day(spark, d):
    raw = C.read_raw(spark, raw_folder(spark, d))
    return raw.groupBy(day_text()).agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("events"))


@query("snk_parquet_by_day", f"""with {CURATED_SQL}
select strftime(dt, '%Y-%m-%d') as dt, count(*) as rows, round(sum(watch_minutes), 2) as minutes,
       sum(is_long_view)::bigint as long_views from c group by 1""")
def snk_parquet_by_day(spark, d):
    return spark.read.parquet(curated_folder(spark, d)).groupBy(day_text()).agg(
        F.count("*").alias("rows"), F.round(F.sum("watch_minutes"), 2).alias("minutes"),
        F.sum("is_long_view").alias("long_views"),
    )


@query("rpt_curate_summary", f"""with {CURATED_SQL}
select count(*) as rows, count(distinct subscriber_id) as subscribers, count(distinct dt) as days from c""")
def rpt_curate_summary(spark, d):
    return C.curate_summary(spark.read.parquet(curated_folder(spark, d)))


@query("rpt_compression")
def rpt_compression(spark, d):
    raw = C.files_and_bytes(spark, raw_folder(spark, d)).withColumn("side", F.lit("csv"))
    out = C.files_and_bytes(spark, curated_folder(spark, d)).withColumn("side", F.lit("parquet"))
    one = raw.unionByName(out).agg(
        F.max(F.when(F.col("side") == "csv", F.col("bytes"))).alias("bytes_in"),
        F.max(F.when(F.col("side") == "parquet", F.col("bytes"))).alias("bytes_out"),
    )
    return one.withColumn("ratio", F.round(F.col("bytes_in") / F.col("bytes_out"), 2))


@query("src_parquet_columns", f"""with {WATCH_SQL}
select subscriber_id, watch_minutes, completed, content_id from w""")
def src_parquet_columns(spark, d):
    return watch_events(spark, d).select("subscriber_id", "watch_minutes", "completed", "content_id")


@query("scan_recent_days", f"""with {CURATED_SQL}
select strftime(dt, '%Y-%m-%d') as dt, count(*) as rows, count(distinct subscriber_id) as subscribers
from c where dt >= date '{CUTOFF}' group by 1""")
def scan_recent_days(spark, d):
    kept = C.recent_days(spark.read.parquet(curated_folder(spark, d)), CUTOFF)
    return kept.groupBy(day_text()).agg(
        F.count("*").alias("rows"), F.countDistinct("subscriber_id").alias("subscribers")
    )


@query("src_jdbc_subscribers", f"with {SUBS_SQL} select * from s")
def src_jdbc_subscribers(spark, d):
    return readers.subscribers(lambda wanted: subscribers(spark, d).select(*wanted))


@query("flt_valid_events", f"""with {WATCH_SQL}
select event_id, subscriber_id, watch_minutes from w
where subscriber_id is not null and watch_minutes > 0 and watch_minutes <= 240""")
def flt_valid_events(spark, d):
    return C.valid_events(watch_events(spark, d)).select("event_id", "subscriber_id", "watch_minutes")


@query("prj_long_view", f"with {WATCH_SQL} select event_id, (watch_minutes >= 30)::int as is_long_view from w")
def prj_long_view(spark, d):
    return C.long_view_flag(watch_events(spark, d)).select("event_id", "is_long_view")


@query("dedup_event_id", f"""with {DEDUP_SQL}
select event_id, subscriber_id, content_id, watch_minutes, device, completed, strftime(dt, '%Y-%m-%d') as dt from u""")
def dedup_event_id(spark, d):
    return C.one_per_event(doubled_events(spark, d), "smallest").select(
        "event_id", "subscriber_id", "content_id", "watch_minutes", "device", "completed", day_text()
    )


@query("union_daily", f"""with {WATCH_SQL}, both_halves as (
  select * from w where dt < date '{CUTOFF}' union all select * from w where dt >= date '{CUTOFF}')
select row_number() over (order by dt, event_id) - 1 as row_id, event_id, subscriber_id,
       strftime(dt, '%Y-%m-%d') as dt from both_halves""")
def union_daily(spark, d):
    events = watch_events(spark, d)
    cut = F.lit(CUTOFF).cast("date")
    stacked = C.union_daily([events.filter(F.col("dt") < cut), C.recent_days(events, CUTOFF)])
    return C.renumbered(stacked, "event_id").select("row_id", "event_id", "subscriber_id", day_text())


@query("agg_squash", f"""with {USAGE_SQL}
select subscriber_id, round(minutes_30d, 4) as minutes_30d, sessions_30d,
       round(completion_rate, 6) as completion_rate, distinct_titles_30d from usage""")
def agg_squash(spark, d):
    usage = X.squash(C.recent_days(watch_events(spark, d), CUTOFF))
    return usage.withColumns({
        "minutes_30d": F.round("minutes_30d", 4), "completion_rate": F.round("completion_rate", 6),
    })


@query("udf_table_fn", f"""with {USAGE_SQL}
select subscriber_id, round(minutes_30d, 4) as minutes_30d, sessions_30d from usage""")
def udf_table_fn(spark, d):
    usage = C.recent_days(watch_events(spark, d), CUTOFF).transform(X.squash)
    return usage.select("subscriber_id", F.round("minutes_30d", 4).alias("minutes_30d"), "sessions_30d")


@query("join_left_zero_fill", f"""with {TRAINING_SQL}
select subscriber_id, plan, churned_next_30d, round(minutes_30d, 4) as minutes_30d, sessions_30d,
       round(completion_rate, 6) as completion_rate, distinct_titles_30d from t""")
def join_left_zero_fill(spark, d):
    return training_table(spark, d).select(
        "subscriber_id", "plan", "churned_next_30d", F.round("minutes_30d", 4).alias("minutes_30d"), "sessions_30d",
        F.round("completion_rate", 6).alias("completion_rate"), "distinct_titles_30d",
    )


@query("agg_group_summary", f"""with {TRAINING_SQL}
select churned_next_30d, count(*) as people, round_even(avg(minutes_30d), 1) as minutes,
       round_even(avg(sessions_30d), 1) as sessions from t group by 1""")
def agg_group_summary(spark, d):
    return X.group_summary(training_table(spark, d), "churned_next_30d")


@query("agg_label_rate", f"""with {SUBS_SQL}
select count(*) as people, round(avg(churned_next_30d), 6) as rate, sum(churned_next_30d)::bigint as positives from s""")
def agg_label_rate(spark, d):
    return X.label_rate(subscribers(spark, d), "churned_next_30d").withColumn("rate", F.round("rate", 6))


@query("agg_distinct_counts", f"""with {WATCH_SQL}
select count(distinct subscriber_id) as subscribers, count(distinct dt) as days from w""")
def agg_distinct_counts(spark, d):
    return C.distinct_counts(watch_events(spark, d))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("ml_one_hot", "select c_custkey as subscriber_id, " + ", ".join(
    f"(c_mktsegment = '{v}')::int as \"plan_{v}\"" for v in _SEGMENTS) + " from customer")
def ml_one_hot(spark, d):
    people = load(spark, d, "customer").select(
        F.col("c_custkey").alias("subscriber_id"), F.col("c_mktsegment").alias("plan")
    )
    return X.one_hot(people, "plan")


@query("split_stratified", """
with r as (
  select doc_id, quality,
         row_number() over (partition by quality order by md5(concat('42:', doc_id::varchar)), doc_id) as place,
         round(0.25 * count(*) over (partition by quality)) as n_test
  from labels)
select doc_id, quality, case when place <= n_test then 'test' else 'train' end as split from r""")
def split_stratified(spark, d):
    rows = load(spark, d, "labels").select("doc_id", "quality")
    return X.stratified_split(rows, "quality", "doc_id", 0.25, 42).select("doc_id", "quality", "split")


@query("ml_scale", """
select c_custkey, round((c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over (), 6) as acctbal_scaled
from customer""")
def ml_scale(spark, d):
    people = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    return X.scaled(people, ["c_acctbal"]).select("c_custkey", F.round("c_acctbal_scaled", 6).alias("acctbal_scaled"))


@query("ml_auc", """
with x as (select quality, avg_rank from (
    select l.quality, rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2.0 as avg_rank
    from labels l join documents using (doc_id)))
select round((sum(case when quality = 1 then avg_rank end)
         - sum(quality) * (sum(quality) + 1) / 2.0) / (sum(quality) * sum(1 - quality))::double, 8) as auc from x""")
def ml_auc(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    scored = load(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id")
    return L.auc(scored, "quality", "score").select(F.round("auc", 8).alias("auc"))


def _features(spark, d) -> DataFrame:
    table = training_table(spark, d)
    for column in ("plan", "country", "payment_method"):
        table = X.one_hot(table, column)
    return table


@query("ml_train_churn")
def ml_train_churn(spark, d):
    table = stage(_features(spark, d), "features")
    parts = X.stratified_split(table, "churned_next_30d", "subscriber_id", 0.25, 42)
    model, columns = L.train_boosted(parts.filter("split = 'train'").drop("split"), "churned_next_30d",
                                     ["subscriber_id"])
    scored = L.score(model, columns, parts.filter("split = 'test'"))
    return L.auc(scored, "churned_next_30d", "probability").select(F.round("auc", 4).alias("auc"), "positives", "negatives")


@query("ml_importance")
def ml_importance(spark, d):
    # small rows in few files: hundreds of rounds over them are spread over all cores
    table = dealt(stage(_features(spark, d), "features"))
    model, columns = L.train_boosted(table, "churned_next_30d", ["subscriber_id"])
    return L.importances(spark, model, columns)


@query("ml_tune")
def ml_tune(spark, d):
    table = _features(spark, d)
    return L.tune(table, "churned_next_30d", ["subscriber_id"], depths=[2, 4], rounds=[3], rates=[0.05, 0.1])


_FEATURES_SQL = """f as (
  select case when p_size % 2 = 0 then concat('country_', p_brand) else p_brand end as feature,
         avg(p_retailprice) / 1000 as importance from part group by 1)"""


def _part_features(spark, d) -> DataFrame:
    feature = F.expr("case when p_size % 2 = 0 then concat('country_', p_brand) else p_brand end")
    return load(spark, d, "part").groupBy(feature.alias("feature")).agg(
        (F.avg("p_retailprice") / 1000).alias("importance")
    )


@query("topk_features", f"""with {_FEATURES_SQL}
select feature, round(importance, 6) as importance from f order by round(importance, 9) desc, feature limit 8""")
def topk_features(spark, d):
    top = L.top_features(_part_features(spark, d), 8)
    return top.withColumn("importance", F.round("importance", 6))


@query("agg_importance_spread", f"""with {_FEATURES_SQL}
select starts_with(feature, 'country_') as is_noise, count(*) as features, round(min(importance), 6) as low,
       round(max(importance), 6) as high, round(max(importance) - min(importance), 6) as spread from f group by 1""")
def agg_importance_spread(spark, d):
    spread = L.importance_spread(_part_features(spark, d), "country_")
    return spread.withColumns({c: F.round(c, 6) for c in ("low", "high", "spread")})


_RUNS_SQL = """runs as (
  select concat('model_', p_brand) as model, p_partkey as run_id, p_size as student_id, p_retailprice / 3000 as auc
  from part)"""


def _runs(spark, d) -> DataFrame:
    return load(spark, d, "part").select(
        F.concat(F.lit("model_"), "p_brand").alias("model"), F.col("p_partkey").alias("run_id"),
        F.col("p_size").alias("student_id"), (F.col("p_retailprice") / 3000).alias("auc"),
    )


@query("rank_model_versions", f"""with {_RUNS_SQL}
select model, run_id, row_number() over (partition by model order by run_id) as version,
       (row_number() over (partition by model order by auc desc, run_id)) = 1 as is_best from runs""")
def rank_model_versions(spark, d):
    return L.model_versions(_runs(spark, d)).select("model", "run_id", "version", "is_best")


@query("ml_leaderboard", f"""with {_RUNS_SQL}, best as (
  select student_id, count(*) as runs, max(auc) as auc from runs group by 1)
select student_id, runs, round(auc, 6) as auc, rank() over (order by auc desc) as place from best""")
def ml_leaderboard(spark, d):
    return L.leaderboard(_runs(spark, d)).withColumn("auc", F.round("auc", 6))
