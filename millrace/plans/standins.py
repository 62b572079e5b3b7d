"""Input tables of the inventory expressed over the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import load

CUTOFF = "2024-01-15"

WATCH_SQL = """w as (
  select event_id, user_id::int as subscriber_id, json_extract_string(props, '$.k')::int as content_id,
         ts::date as event_date, value as watch_minutes, event_type as device,
         (event_type = 'purchase')::int as completed, ts::date as dt
  from events)"""

SUBS_SQL = """s as (
  select c_custkey::int as subscriber_id, c_mktsegment as plan, concat('N', c_nationkey::varchar) as country,
         case c_custkey % 3 when 0 then 'card' when 1 then 'transfer' else 'wallet' end as payment_method,
         c_acctbal as monthly_price, (c_custkey % 5)::int as support_tickets_90d,
         (c_custkey % 60)::int as tenure_months, (c_acctbal < 0)::int as churned_next_30d
  from customer)"""

# events, plus a second, longer copy of every 'error' event under the same id
DOUBLED_SQL = WATCH_SQL + """, r as (
  select * from w
  union all
  select event_id, subscriber_id, content_id, event_date, watch_minutes + 1.0, device, completed, dt
  from w where device = 'error')"""

DEDUP_SQL = DOUBLED_SQL + """, u as (
  select * exclude (rn) from (
    select *, row_number() over (partition by event_id
      order by subscriber_id, content_id, event_date, watch_minutes, device, completed, dt) as rn from r)
  where rn = 1)"""

CURATED_SQL = DEDUP_SQL + """, c as (
  select *, (watch_minutes >= 30)::int as is_long_view from u
  where subscriber_id is not null and watch_minutes > 0 and watch_minutes <= 240)"""

USAGE_SQL = WATCH_SQL + f""", usage as (
  select subscriber_id, coalesce(sum(watch_minutes), 0) as minutes_30d, count(watch_minutes) as sessions_30d,
         avg(completed) as completion_rate, count(distinct content_id) as distinct_titles_30d
  from w where dt >= date '{CUTOFF}' and subscriber_id is not null group by subscriber_id)"""

TRAINING_SQL = USAGE_SQL + ", " + SUBS_SQL + """, t as (
  select s.*, coalesce(minutes_30d, 0) as minutes_30d, coalesce(sessions_30d, 0) as sessions_30d,
         coalesce(completion_rate, 0) as completion_rate, coalesce(distinct_titles_30d, 0) as distinct_titles_30d
  from s left join usage using (subscriber_id))"""


def watch_events(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("ts")
    return load(spark, d, "events").select(
        "event_id",
        F.col("user_id").cast("int").alias("subscriber_id"),
        F.get_json_object("props", "$.k").cast("int").alias("content_id"),
        day.alias("event_date"),
        F.col("value").alias("watch_minutes"),
        F.col("event_type").alias("device"),
        (F.col("event_type") == "purchase").cast("int").alias("completed"),
        day.alias("dt"),
    )


def doubled_events(spark: SparkSession, d: str) -> DataFrame:
    events = watch_events(spark, d)
    copies = events.filter("device = 'error'").withColumn("watch_minutes", F.col("watch_minutes") + 1.0)
    return events.unionByName(copies)


def subscribers(spark: SparkSession, d: str) -> DataFrame:
    method = F.expr("case c_custkey % 3 when 0 then 'card' when 1 then 'transfer' else 'wallet' end")
    return load(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("subscriber_id"),
        F.col("c_mktsegment").alias("plan"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        method.alias("payment_method"),
        F.col("c_acctbal").alias("monthly_price"),
        F.expr("cast(c_custkey % 5 as int)").alias("support_tickets_90d"),
        F.expr("cast(c_custkey % 60 as int)").alias("tenure_months"),
        (F.col("c_acctbal") < 0).cast("int").alias("churned_next_30d"),
    )
