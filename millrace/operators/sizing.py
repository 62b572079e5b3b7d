"""How rows reach costly work: measured broadcasts, spreading, computing once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A join side up to this many rows, and bytes, is sent to every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def _bytes_of(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        size = F.size(column) * 8
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(column)))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("bigint"), F.lit(0)) + 8


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it is measured to be small, in rows and bytes, else left to a shuffle join.

    Meant for staged or source tables: measuring must be cheap. Reading stops at the limit of rows.
    """
    each = reduce(Column.__add__, [_bytes_of(f) for f in df.schema.fields])
    n, total = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(each), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and total <= size else df


def spread(source: DataFrame) -> DataFrame:
    """A source read in fewer pieces than there are cores, dealt out to all of them.

    For work that costs far more than moving its input (models, tokenising). Large inputs arrive
    in more pieces than cores and stay where they are. ``source`` must be a plain scan.
    """
    cores = source.sparkSession.sparkContext.defaultParallelism
    return source.repartition(cores) if source.rdd.getNumPartitions() < cores else source


#: Rows of a piece that are worth moving to another core.
PIECE_ROWS = 20_000


def dealt(rows: DataFrame, each: int = PIECE_ROWS) -> DataFrame:
    """Rows dealt out evenly to all cores, if there are so many for each of two.

    Small rows that cost much, such as texts made and parsed, come in few files or in few pieces that can be read apart, however many
    pieces a plan counts. Counting must be cheap: a plain scan or a staged table.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = min(cores, rows.count() // each)
    return rows.repartition(cores) if n > 1 else rows


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that is computed once per row.

    A plain column would be copied into every expression and filter that uses it; the optimizer
    does not copy across an explode, here of a one-element array.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
