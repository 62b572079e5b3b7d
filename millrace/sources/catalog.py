"""What tables exist, what they hold, and whether they hold what they should."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.sources.staging import stage


def table_names(spark: SparkSession, expected: list[str] = ()) -> list[str]:
    """Sorted names in the catalog; a missing expected table is an error."""
    names = sorted(t.name for t in spark.catalog.listTables())
    missing = sorted(set(expected) - set(names))
    if missing:
        raise LookupError(f"missing tables: {missing}")
    return names


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) over all tables; each count reads no column at all."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def table_info(name: str, df: DataFrame) -> DataFrame:
    """(table_name, position, column_name, data_type, filled): one scan per table."""
    fields = df.schema.fields
    filled = df.agg(*[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[
        F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"c{i}").alias("filled"))
        for i, f in enumerate(fields)
    ])
    return filled.select(F.lit(name).alias("table_name"), F.explode(rows).alias("r")).select("table_name", "r.*")


def sample_rows(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The n rows with the lowest key, the same ones on every run."""
    return df.orderBy(key).limit(n)


def described(name: str, df: DataFrame, keys: list[str], n: int = 3, wide: int = 40) -> DataFrame:
    """``table_info`` with a column ``sample``: the values of the n rows with the lowest keys, cut to ``wide`` characters each,
    in the order of their keys.

    The keys are looked up first, by a scan that reads nothing else; the rows are fetched by a filter that files can skip by.
    """
    lowest = df.select(*keys).orderBy(*keys).limit(n).collect()
    last = F.lit(False)
    for r in lowest:
        last = last | reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(r[k])) for k in keys])
    rows = df.where(last).orderBy(*keys).limit(n)
    shown = [F.concat(F.size(f"`{f.name}`").cast("string"), F.lit(" values")) if isinstance(f.dataType, (T.ArrayType, T.MapType))
             else F.left(F.col(f"`{f.name}`").cast("string"), F.lit(wide)) for f in df.schema.fields]
    cells = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.coalesce(c, F.lit("NULL")).alias("value"))
                      for i, c in enumerate(shown)])
    # at most n values per column meet in a group
    sample = (rows.select(F.struct(*keys).alias("key"), F.explode(cells).alias("cell")).groupBy("cell.position")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key", "cell.value"))), lambda x: x["value"]), " | ").alias("sample")))
    return table_info(name, df).join(F.broadcast(sample), "position", "left").select(
        "table_name", "position", "column_name", "data_type", "filled", "sample")


def check_counts(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """(table_name, expected, actual, status): ok, MISMATCH or MISSING for every expected table."""
    both = expected.join(counts, "table_name", "left")
    status = (
        F.when(F.col("rows").isNull(), "MISSING").when(F.col("rows") == F.col("expected"), "ok").otherwise("MISMATCH")
    )
    return both.select("table_name", "expected", F.col("rows").alias("actual"), status.alias("status"))


def all_ok(checked: DataFrame) -> bool:
    return checked.filter("status <> 'ok'").isEmpty()


def ensure_tables(
    current: Mapping[str, DataFrame], expected: DataFrame, rebuild: Callable[[], Mapping[str, DataFrame]]
) -> tuple[Mapping[str, DataFrame], bool]:
    """The current tables if they pass, else rebuilt ones: written aside, checked, then handed over.

    Returns (tables, rebuilt). The old files stay untouched; a rebuild that fails its check raises.
    """
    if current and all_ok(check_counts(row_counts(current), expected)):
        return current, False
    built = {name: stage(df, f"table-{name}") for name, df in rebuild().items()}
    bad = check_counts(row_counts(built), expected).filter("status <> 'ok'")
    if not bad.isEmpty():
        raise ValueError(f"rebuilt tables fail their check: {[r.asDict() for r in bad.collect()]}")
    return built, True
