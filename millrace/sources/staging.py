"""Tables written to the folder that all executors share.

A staged table cuts lineage: whatever is lost later is read back from files instead of being
computed again, and two readers are sure to see the same rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
#: Spark's setting that removes a query's shuffle files when it ends. Without it they stay until the driver collects its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or by ``setCheckpointDir``.

    Only a local session, whose executors are threads of the driver, may do without: it gets a folder of its own.
    """
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    given = spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="millrace-")
    return _own_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that begin and end in here leave no shuffle files behind."""
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and hand back a reader over the written files. What was shuffled for it goes."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def unstage(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` has handed back: all that reads them has ended, and no result will read them. Others stay."""
    for df in tables:
        named = df.__dict__.pop("_staged_at", None)
        if named:
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(named)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def write_by(df: DataFrame, column: str, path: str, fmt: str = "parquet", **options: object) -> None:
    """Overwrite ``path`` with one folder per value of ``column``, usually one file in each.

    A rebalance rather than a plain repartition: adaptive execution packs small values together
    and cuts a value that outgrows the advisory partition size into several files instead of
    pressing it through one task. A task thus holds about one advisory size of rows; the session may let it keep
    the files of its values open side by side (spark.sql.maxConcurrentOutputFileWriters) instead of sorting.
    """
    writer = df.hint("rebalance", column).write.mode("overwrite").partitionBy(column)
    writer.format(fmt).options(**options).save(path)
