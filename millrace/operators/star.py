"""Business questions over a star schema, job tables and event streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.formats import fixed
from millrace.operators.ordering import exact_quantiles


def total_by_group(facts: DataFrame, key: str, amount: str, members: DataFrame, groups: DataFrame, group: str,
                   member_group: str) -> DataFrame:
    """Sum of ``amount`` per group name over facts -> members -> groups.

    Facts are summed per member first: a member holding most facts shrinks to one row per task
    before anything is shuffled or joined.
    """
    per_member = facts.groupBy(key).agg(F.sum(amount).alias("total"))
    return (
        per_member.join(members, key).join(groups, member_group)
        .groupBy(group).agg(F.sum("total").alias("total"))
    )


def top_by_distinct(facts: DataFrame, key: str, thing: str, names: DataFrame, name: str) -> DataFrame:
    """The one name with the most distinct things, ties by name."""
    counts = facts.groupBy(key).agg(F.countDistinct(thing).alias("things"))
    return counts.join(names, key).select(name, "things").orderBy(F.col("things").desc(), name).limit(1)


def status_counts(jobs: DataFrame, status: str = "status") -> DataFrame:
    """Jobs per status with what it means for the cluster: running, queued or over."""
    s = F.col(status)
    load = F.when(s == "running", "running").when(s.isin("pending", "created"), "queued").otherwise("over")
    return jobs.groupBy(s.alias("status")).agg(F.count("*").alias("jobs")).withColumn("load", load)


def cluster_load(jobs: DataFrame, status: str = "status") -> DataFrame:
    s = F.col(status)
    return jobs.agg(
        F.count(F.when(s == "running", 1)).alias("running"),
        F.count(F.when(s.isin("pending", "created"), 1)).alias("queued"),
    )


def job_phase(status: Column, steps: Column, percent: Column, loss: Column) -> Column:
    """What a training job is doing, in words. The sentences are fixed values."""
    step = F.coalesce(steps, F.lit(0))
    share = fixed(F.coalesce(percent, F.lit(0.0)), 0)
    base = F.concat(F.lit("training - step "), step.cast("string"), F.lit(", "), share, F.lit("%"))
    loss_part = F.when(loss.isNull(), "").otherwise(F.concat(F.lit(", loss "), fixed(loss, 3)))
    return (
        F.when(status.isin("pending", "created"), "queued, waiting for a free GPU slot")
        .when(step == 0, "preparing (loading base model and data)")
        .otherwise(F.concat(base, loss_part))
    )


def slow_cells(cells: DataFrame, seconds: str, threshold: float = 5.0) -> DataFrame:
    """Cells above the threshold, longest first, each with the minutes of the whole run.

    The total is a scalar sub-query over the unfiltered cells.
    """
    total = cells.agg((F.sum(seconds) / 60).alias("m")).scalar()
    return (
        cells.filter(F.col(seconds) > threshold).withColumn("total_minutes", total).orderBy(F.col(seconds).desc())
    )


def latency(requests: DataFrame, model: str, value: str, at: str) -> DataFrame:
    """Per model: requests, exact median and 95th percentile, requests per second of its time span.

    A model whose requests all fall within one second has no rate: null.
    """
    spread = requests.groupBy(model).agg(
        F.count("*").alias("requests"),
        (F.unix_timestamp(F.max(at).cast("timestamp")) - F.unix_timestamp(F.min(at).cast("timestamp"))).alias("seconds"),
    )
    points = exact_quantiles(requests, [model], value, [0.5, 0.95])
    return spread.join(points, model).withColumn("per_second", F.try_divide(F.col("requests"), F.col("seconds")))


def as_text_of(value: Column, kind: T.DataType) -> Column:
    """A value as text that does not depend on how an engine prints doubles."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # what no decimal holds (NaN, infinity, very large numbers) is shown as it is
        return F.coalesce(value.try_cast("decimal(30,4)").cast("string"), value.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value.cast("string")


def _named(column: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + column.replace("`", "``") + "`")


def profile(df: DataFrame) -> DataFrame:
    """(column_name, rows, nulls, distinct_values, lowest, highest) for every column.

    Each column is read alone and counted per value, partly before its shuffle; together the
    narrow scans read the table once.
    """
    parts = []
    for field in df.schema.fields:
        value = F.col("v")
        counted = df.select(_named(field.name).alias("v")).groupBy("v").agg(F.count("*").alias("n"))
        parts.append(counted.agg(
            F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count(value).alias("distinct_values"), as_text_of(F.min(value), field.dataType).alias("lowest"),
            as_text_of(F.max(value), field.dataType).alias("highest"),
        ).select(F.lit(field.name).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def approximate_profile(df: DataFrame) -> DataFrame:
    """(column_name, rows, nulls, distinct_values) in one pass; distinct counts are estimates."""
    names = df.columns
    one = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.when(_named(n).isNull(), 1)).alias(f"nu{i}") for i, n in enumerate(names)],
        *[F.approx_count_distinct(_named(n)).alias(f"di{i}") for i, n in enumerate(names)],
    )
    cells = F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col("rows"), F.col(f"nu{i}").alias("nulls"),
                 F.col(f"di{i}").alias("distinct_values")) for i, n in enumerate(names)
    ])
    return one.select(F.explode(cells).alias("c")).select("c.*")
