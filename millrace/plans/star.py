"""Star-schema questions, job tables, timings and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import star as S
from millrace.plans.registry import query
from millrace.session import load


@query("flt_salary", "select c_name as name from customer where c_acctbal > 9000")
def flt_salary(spark, d):
    return load(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_name").alias("name"))


@query("flt_department", "select c_name as name from customer where c_mktsegment = 'BUILDING'")
def flt_department(spark, d):
    return load(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("name"))


@query("prj_employee_names", "select c_name as name from customer")
def prj_employee_names(spark, d):
    return load(spark, d, "customer").select(F.col("c_name").alias("name"))


@query("join_sales_by_country", """
select n_name as country, round(sum(o_totalprice), 2) as total
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""")
def join_sales_by_country(spark, d):
    facts = load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    members = load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    groups = load(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    totals = S.total_by_group(facts, "c_custkey", "o_totalprice", members, groups, "country", "n_nationkey")
    return totals.withColumn("total", F.round("total", 2))


@query("join_employee_department", """
select c_name as name, c_acctbal as salary from customer join nation on c_nationkey = n_nationkey
where n_name = 'NATION_7'""")
def join_employee_department(spark, d):
    people = load(spark, d, "customer")
    department = load(spark, d, "nation").filter("n_name = 'NATION_7'")
    return people.join(department, people.c_nationkey == department.n_nationkey).select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("salary")
    )


@query("agg_distinct_artists", "select count(distinct s_name) as artists from supplier")
def agg_distinct_artists(spark, d):
    return load(spark, d, "supplier").agg(F.countDistinct("s_name").alias("artists"))


@query("agg_top_artist", """
select s_name as artist, count(distinct l_partkey) as things from lineitem join supplier on l_suppkey = s_suppkey
group by 1 order by 2 desc, 1 limit 1""")
def agg_top_artist(spark, d):
    facts = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_partkey")
    names = load(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("artist"))
    return S.top_by_distinct(facts, "s_suppkey", "l_partkey", names, "artist")


_STATUS = "case o_orderstatus when 'P' then 'pending' when 'O' then 'running' else 'completed' end"


@query("agg_status_counts", f"""
with j as (select {_STATUS} as status from orders)
select status, count(*) as jobs, case when status = 'running' then 'running'
       when status in ('pending', 'created') then 'queued' else 'over' end as load
from j group by status""")
def agg_status_counts(spark, d):
    return S.status_counts(load(spark, d, "orders").select(F.expr(_STATUS).alias("status")))


@query("prj_job_phase", """
with j as (
  select o_orderkey as job_id,
    case o_orderstatus when 'P' then 'pending' when 'O' then 'created' else 'running' end as status,
    (o_orderkey % 7)::int as steps, o_totalprice / 5000.0::double as pct,
    case when o_orderpriority = '5-LOW' then null else o_totalprice / 1000000.0::double end as loss
  from orders)
select job_id, case when status in ('pending', 'created') then 'queued, waiting for a free GPU slot'
  when steps = 0 then 'preparing (loading base model and data)'
  else concat('training - step ', steps::varchar, ', ', printf('%.0f', pct), '%',
    case when loss is not null then concat(', loss ', printf('%.3f', loss)) else '' end) end as phase
from j""")
def prj_job_phase(spark, d):
    orders = load(spark, d, "orders")
    jobs = orders.selectExpr(
        "o_orderkey as job_id",
        "case o_orderstatus when 'P' then 'pending' when 'O' then 'created' else 'running' end as status",
        "cast(o_orderkey % 7 as int) as steps", "o_totalprice / 5000.0D as pct",
        "case when o_orderpriority = '5-LOW' then null else o_totalprice / 1000000.0D end as loss",
    )
    return jobs.select("job_id", S.job_phase(F.col("status"), F.col("steps"), F.col("pct"), F.col("loss")).alias("phase"))


@query("agg_run_timing", """
select l_orderkey, l_linenumber, l_partkey, l_tax * 100 as seconds,
       (select round(sum(l_tax * 100) / 60, 4) from lineitem) as total_minutes
from lineitem where l_tax * 100 > 5""")
def agg_run_timing(spark, d):
    cells = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_tax") * 100).alias("seconds")
    )
    return S.slow_cells(cells, "seconds").withColumn("total_minutes", F.round("total_minutes", 4))


@query("agg_latency", """
select event_type as model, count(*) as requests, quantile_disc(value, 0.5) as p50, quantile_disc(value, 0.95) as p95,
  round(count(*) / (epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts)))), 8) as per_second
from events group by 1""")
def agg_latency(spark, d):
    requests = load(spark, d, "events").select(F.col("event_type").alias("model"), "value", "ts")
    return S.latency(requests, "model", "value", "ts").select(
        "model", "requests", "p50", "p95", F.round("per_second", 8).alias("per_second")
    )


def _profile_sql() -> str:
    shown = {
        "event_id": "{}::varchar", "ts": "strftime({}, '%Y-%m-%d %H:%M:%S')", "user_id": "{}::varchar",
        "event_type": "{}", "value": "{}::decimal(30,4)::varchar", "props": "{}",
    }
    return " union all ".join(
        f"select '{c}' as column_name, count(*) as rows, count(*) - count({c}) as nulls, "
        f"count(distinct {c}) as distinct_values, {s.format(f'min({c})')} as lowest, {s.format(f'max({c})')} as highest "
        f"from events" for c, s in shown.items()
    )


@query("prof_columns", _profile_sql())
def prof_columns(spark, d):
    return S.profile(load(spark, d, "events"))


# Job parameters: the raw text a student might have typed, taken from the customer table.
_RAW_ID = """case c_mktsegment when 'BUILDING' then c_name when 'AUTOMOBILE' then null
  when 'MACHINERY' then cast(c_nationkey as {s}) else cast(c_custkey as {s}) end"""


@query("chk_job_params", f"""
with p as (select c_custkey as run_id, {_RAW_ID.format(s='varchar')} as raw from customer)
select run_id, case when raw is null then 'no student_id supplied' when not regexp_full_match(raw, '[+-]?[0-9]+')
    then 'not an integer' when raw::bigint not between 0 and 99 then 'out of range (0-99)' else 'ok' end as verdict,
  case when regexp_full_match(coalesce(raw, ''), '[+-]?[0-9]+') and try_cast(raw as bigint) between 0 and 99
    then lpad(raw::bigint::varchar, 2, '0') end as sid
from p""")
def chk_job_params(spark, d):
    from millrace.functions.formats import student_id
    raw = load(spark, d, "customer").select(F.col("c_custkey").alias("run_id"), F.expr(_RAW_ID.format(s="string")).alias("raw"))
    verdict, sid = student_id(F.col("raw"))
    return raw.select("run_id", verdict.alias("verdict"), sid.alias("sid"))


@query("prj_run_paths", f"""
with p as (select c_custkey as run_id, {_RAW_ID.format(s='varchar')} as raw from customer),
v as (select run_id, lpad(try_cast(raw as bigint)::varchar, 2, '0') as sid from p
      where regexp_full_match(coalesce(raw, ''), '[+-]?[0-9]+') and try_cast(raw as bigint) between 0 and 99)
select run_id, sid, concat('curated/student-', sid, '/watch_events') as out_path,
       concat('curate-events-student-', sid) as app_name from v""")
def prj_run_paths(spark, d):
    from millrace.functions.formats import run_paths, student_id
    raw = load(spark, d, "customer").select(F.col("c_custkey").alias("run_id"), F.expr(_RAW_ID.format(s="string")).alias("raw"))
    _, sid = student_id(F.col("raw"))
    valid = raw.select("run_id", sid.alias("sid")).filter("sid is not null")
    out_path, app_name = run_paths(F.col("sid"))
    return valid.select("run_id", "sid", out_path.alias("out_path"), app_name.alias("app_name"))


@query("fmt_metrics", """
select o_orderkey, format('{:,}', o_orderkey * 1000003) as rows_text, printf('%.1f%%', o_totalprice / 1000000.0::double * 100) as share,
       printf('%+.1f%%', (o_totalprice - 250000.0::double) / 1000000.0::double * 100) as change
from orders""")
def fmt_metrics(spark, d):
    from millrace.functions.formats import percent, signed_percent, thousands
    return load(spark, d, "orders").select(
        "o_orderkey", thousands(F.col("o_orderkey") * 1000003).alias("rows_text"),
        percent(F.col("o_totalprice") / 1_000_000.0).alias("share"),
        signed_percent((F.col("o_totalprice") - 250000.0) / 1_000_000.0).alias("change"),
    )
