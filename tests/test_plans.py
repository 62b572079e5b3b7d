"""What the physical plans must and must not contain, over every registered query."""

import contextlib
import io
import re

import pytest

from millrace.plans import QUERIES
from millrace.plans.standins import CUTOFF, watch_events
from millrace.operators import curate as C
from millrace.session import load
from millrace.sources.staging import fresh_path


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# Training fits a model when called; its result is a finished table and has no plan to look at.
FITTED = {"ml_train_churn", "ml_importance", "ml_tune"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FITTED])
def test_no_cross_join_and_no_row_python(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_partition_filter_and_narrow_read(spark, sf):
    path = fresh_path(spark, "plan")
    C.write_curated(C.curate(watch_events(spark, sf)), path)
    plan = plan_of(C.recent_days(spark.read.parquet(path), CUTOFF).select("subscriber_id", "dt"))
    assert re.search(r"PartitionFilters: \[.*dt", plan)
    assert "ReadSchema: struct<subscriber_id:int>" in plan


def test_value_filter_reaches_the_scan(spark, sf):
    plan = plan_of(load(spark, sf, "customer").filter("c_acctbal > 9000").select("c_name"))
    assert "GreaterThan(c_acctbal,9000.0)" in plan
    assert "c_mktsegment" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_top_k_is_cut_before_the_shuffle(spark, sf):
    from millrace.operators.chat import first_turns
    plan = plan_of(first_turns(load(spark, sf, "conversations"), 8))
    assert plan.count("WindowGroupLimit") >= 2


def test_running_values_shuffle_rows_once(spark, sf):
    """A second pass over the same keys and blocks finds the rows in place."""
    from pyspark.sql import functions as F
    from millrace.operators.ordering import blocked_running
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = load(spark, sf, "conversations").withColumn("_block", F.floor(F.col("turn") / 4))
        once = blocked_running(rows, ["conv_id"], [F.col("turn")], ["_block"], {"n": ("sum", F.lit(1))})
        plan = plan_of(once)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange for the rows, two for the totals (sum, then place beside the rows) and one per window
    wide = [e for e in re.findall(r"Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan) if "text" in e]
    assert len(wide) == 1


def test_small_sides_are_measured_in_bytes(spark):
    from pyspark.sql import functions as F

    from millrace.operators.sizing import small_side
    some = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.struct("id")).alias("a"))

    def marked(df):
        return "Hint" in df._jdf.queryExecution().analyzed().toString()

    assert marked(small_side(some)) and not marked(small_side(some, rows=99)) and not marked(small_side(some, size=100_000))
