"""Readers: database tables, fallback paths, raw bytes, page texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SUBSCRIBER_COLUMNS = [
    "subscriber_id", "plan", "country", "payment_method", "monthly_price", "support_tickets_90d",
    "tenure_months", "churned_next_30d",
]


def subscribers(reader: Callable[[list[str]], DataFrame]) -> DataFrame:
    """The eight subscriber columns, from whichever reader the caller has."""
    return reader(SUBSCRIBER_COLUMNS).select(*SUBSCRIBER_COLUMNS)


def jdbc_reader(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, parts: int,
    properties: dict[str, str] | None = None,
) -> Callable[[list[str]], DataFrame]:
    """A reader for ``subscribers`` that splits the table into ``parts`` parallel range queries.

    The bounds only place the cuts: rows outside them are read by the first and last part.
    """
    def read(columns: list[str]) -> DataFrame:
        return spark.read.jdbc(
            url, f"(select {', '.join(columns)} from {table}) t", column=partition_column,
            lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties or {},
        )
    return read


# Error conditions that mean "no access to this path"; everything else must surface.
ACCESS_CONDITIONS = ("PATH_NOT_FOUND",)
ACCESS_EXCEPTIONS = ("AccessControlException", "AccessDeniedException")


def _no_access(error: Exception) -> bool:
    condition = getattr(error, "getCondition", lambda: None)()
    return condition in ACCESS_CONDITIONS or any(name in str(error) for name in ACCESS_EXCEPTIONS)


def first_readable_json(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The first path that can be opened; only access errors lead on to the next one. A broken line is an error."""
    refused: Exception | None = None
    for path in paths:
        try:
            return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        except Exception as error:  # noqa: BLE001 - py4j wraps permission errors in several classes
            if not (isinstance(error, AnalysisException) or "Access" in str(error)) or not _no_access(error):
                raise
            refused = error
    raise refused if refused else ValueError("no path given")


def decoded_text(content: Column) -> Column:
    """Bytes as text: UTF-8 without its byte order mark, else Latin-1. No byte is dropped."""
    as_utf8 = F.try_validate_utf8(content.cast("string"))
    return F.coalesce(F.regexp_replace(as_utf8, "^﻿", ""), F.decode(content, "ISO-8859-1"))


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of every file in a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", decoded_text(F.col("content")).alias("text"))


def data_uri(content: Column, mime: str) -> Column:
    """Bytes as a data URI; Spark's base64 breaks lines, a URI must not."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(content), "[\r\n]", ""))


def binary_files(spark: SparkSession, path: str, mime: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", data_uri(F.col("content"), mime).alias("uri"))


def document_pages(spark: SparkSession, path: str, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """(source, page from 1, text): files of a folder cut into pages by the caller's extractor.

    The extractor (a PDF reader, say) sees one file at a time, inside the tasks.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["path"], batch["content"]):
                pages = extract(bytes(content))
                yield pd.DataFrame({"source": source, "page": range(1, len(pages) + 1), "text": pages})

    return files.mapInPandas(cut, "source string, page bigint, text string")


def line_pages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, page, text): each line of a document as a page, numbered from 1."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("page", "text")).withColumn(
        "page", (F.col("page") + 1).cast("bigint")
    )


def joined_pages(pages: DataFrame, key: str) -> DataFrame:
    """The pages of each document back to back, in page order: (key, pages, text).

    One group is one document, whose text is a single value before and after.
    """
    return pages.groupBy(key).agg(
        F.count("*").alias("pages"),
        F.expr("listagg(text, '') within group (order by page)").alias("text"),
    )
