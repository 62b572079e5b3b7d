"""Sets of tables in versions, behind a pointer that moves in one step.

A set lives in a folder. What a version holds is one entry of the folder's log: a single small file that names, for
every table, where its rows are. The newest entry is the pointer. Tables are written aside first, and the entry last; its file
appears as a whole when Spark commits it. Readers see the version before or the one after, and a job that dies in between
leaves the old one in force. Tables that did not change are carried over by their path, not written again, and whoever
still reads an old version finds its files where they were.

Any number of readers, in any session, may look on; publishing is for one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.catalog import check_counts, row_counts

ENTRY = "version long, entry string, table_name string, path string"


class TableSet:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def log(self) -> DataFrame:
        """All entries, one row per version and table."""
        try:
            return self.spark.read.schema(ENTRY).parquet(f"{self.folder}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def current(self) -> tuple[int, dict[str, str]]:
        """The number of the version in force, 0 before the first, and where its tables are."""
        log = self.log()
        newest = log.agg(F.max(F.struct("version", "entry")).alias("last"))
        rows = log.join(F.broadcast(newest), F.struct("version", "entry") == F.col("last")).collect()  # a row per table
        return (rows[0].version if rows else 0), {r.table_name: r.path for r in rows if r.table_name is not None}

    def tables(self) -> dict[str, DataFrame]:
        """The tables of the version in force; one whose files are gone is left out."""
        out = {}
        for name, path in sorted(self.current()[1].items()):
            try:
                out[name] = self.spark.read.parquet(path)
            except AnalysisException as error:
                if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
        return out

    def written(self, table: DataFrame, name: str) -> str:
        """Writes a table aside, where no version points to yet."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        table.write.parquet(path)
        return path

    def publish(self, changed: Mapping[str, DataFrame | str], dropped: tuple[str, ...] = ()) -> int:
        """A new version: the one in force with some tables changed (rows, or the path of rows already there) or dropped."""
        last, paths = self.current()
        paths = {name: path for name, path in paths.items() if name not in dropped}
        paths |= {name: t if isinstance(t, str) else self.written(t, name) for name, t in changed.items()}
        entry = uuid.uuid4().hex
        rows = [(last + 1, entry, name, path) for name, path in sorted(paths.items())] or [(last + 1, entry, None, None)]
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")
        return last + 1

    def check(self, expected: DataFrame) -> DataFrame:
        tables = self.tables()
        counts = row_counts(tables) if tables else self.spark.createDataFrame([], "table_name string, rows long")
        return check_counts(counts, expected)

    def ensure(self, expected: DataFrame, rebuild: Callable[[list[str]], Mapping[str, DataFrame]]) -> list[str]:
        """Makes the version in force hold what is ``expected`` (table_name, expected); the names of tables rebuilt for it.

        If all tables pass, nothing happens. Else ``rebuild`` is given the names of those that do not; their rows are written aside, counted as
        written, and only then put in force. Rows that fail are an error, and the old version stays.
        """
        bad = sorted(r.table_name for r in self.check(expected).filter("status <> 'ok'").collect())
        if not bad:
            return []
        paths = {name: self.written(table, name) for name, table in rebuild(bad).items()}
        counts = row_counts({name: self.spark.read.parquet(path) for name, path in paths.items()})
        failed = check_counts(counts, expected.filter(F.col("table_name").isin(bad))).filter("status <> 'ok'").collect()
        if failed:
            raise ValueError(f"rebuilt tables fail their check: {[r.asDict() for r in failed]}")
        self.publish(paths)
        return bad
