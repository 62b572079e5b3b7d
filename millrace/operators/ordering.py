"""Running totals, positions and ranks that no single task has to hold.

A plain window sorts a whole key in one task, which breaks once a key holds a third of all rows.
Both functions here cut every key into pieces, run the window inside a piece, and add what came
before the piece. They differ in where the pieces come from:

* ``blocked_running``: the caller names an expression that grows with the order (a turn number
  divided by a block length, the first digits of a hash, a day);
* ``range_running``: no such expression exists, so a range partitioning makes the pieces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.sources.staging import stage

# output column -> (kind, input column)
Running = Mapping[str, tuple[str, Column]]

# Running kinds take the key's rows up to the current one; the others all rows of the key.
_RUNNING = {"sum": F.sum, "max": F.max, "min": F.min}
_WHOLE = {"all_sum": F.sum, "all_max": F.max, "all_min": F.min}
_AGG = {**_RUNNING, **_WHOLE}


def _combine(kind: str, before: Column, here: Column | None) -> Column:
    if kind in _WHOLE:
        return before
    if kind == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))
    return (F.greatest if kind == "max" else F.least)(before, here)


def _named(key: str) -> Column:
    """A key column that must have a value: null keys would match nothing and be lost."""
    return F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null in key column {key}"))).otherwise(F.col(key))


def _before(totals: DataFrame, keys: Sequence[str], pieces: Sequence[str], running: Running) -> list[Column]:
    earlier = W.partitionBy(*keys).orderBy(*pieces).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    return [
        _AGG[kind](f"_tot_{name}").over(whole if kind in _WHOLE else earlier).alias(f"_before_{name}")
        for name, (kind, _) in running.items()
    ]


def blocked_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    blocks: Sequence[str],
    running: Running,
) -> DataFrame:
    """Running values per key, first row up to and including the current one.

    ``blocks`` are columns that never decrease along ``order`` within a key; a null in them or in a key is an error. Only (key, block) totals meet in one place per key, i.e. rows / block length
    of them. The rows themselves are shuffled once, by (key, block); further calls with the same
    keys and blocks find them in place.
    """
    inputs = {f"_in_{name}": col for name, (_, col) in running.items()}
    cut = df.withColumns({**{k: _named(k) for k in [*keys, *blocks]}, **inputs})
    piece = [*keys, *blocks]

    totals = cut.groupBy(*piece).agg(
        *[_AGG[kind](f"_in_{name}").alias(f"_tot_{name}") for name, (kind, _) in running.items()]
    )
    before = totals.select(*[F.col(c).alias(f"_k_{c}") for c in piece], *_before(totals, keys, blocks, running))

    inside = W.partitionBy(*piece).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = cut.withColumns({
        f"_here_{name}": _AGG[kind](f"_in_{name}").over(inside) for name, (kind, _) in running.items() if kind in _RUNNING
    })
    joined = local.join(before, [F.col(c) == F.col(f"_k_{c}") for c in piece], "inner")
    return joined.select(
        *df.columns,
        *[_combine(kind, F.col(f"_before_{name}"), F.col(f"_here_{name}") if kind in _RUNNING else None).alias(name)
          for name, (kind, _) in running.items()],
    )


def blocked_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], blocks: Sequence[str], name: str
) -> DataFrame:
    """``row_number()`` per key (1-based, bigint), one block at a time."""
    return blocked_running(df, keys, order, blocks, {name: ("sum", F.lit(1).cast("bigint"))})


def range_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    running: Running,
    partitions: int | None = None,
) -> DataFrame:
    """Running values per key where the order gives no natural blocks.

    Rows are range-partitioned by (key, order), so a hot key and even a hot order value followed
    by a unique tie column spread over many tasks. The partitioned table is staged because two
    readers must agree on where the cuts fell.
    """
    if any(kind in _WHOLE for kind, _ in running.values()):
        raise ValueError("range_running gives running values only")
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    inputs = {f"_in_{name}": col for name, (_, col) in running.items()}
    sort = [*[F.col(k) for k in keys], *order]
    laid_out = stage(
        df.withColumns(inputs)
        .repartitionByRange(n, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranged",
    ).withColumn("_part", F.shiftright("_at", 33))

    inside = W.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    local = laid_out.withColumns(
        {f"_here_{name}": _AGG[kind](f"_in_{name}").over(inside) for name, (kind, _) in running.items()}
    )
    totals = laid_out.groupBy(*keys, "_part").agg(
        *[_AGG[kind](f"_in_{name}").alias(f"_tot_{name}") for name, (kind, _) in running.items()]
    )
    pieces = F.count("*").over(W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    before = totals.select(
        *[F.col(c).alias(f"_k_{c}") for c in [*keys, "_part"]], pieces.alias("_pieces"),
        *_before(totals, keys, ["_part"], running),
    ).filter("_pieces > 0")
    # At most one key continues across each cut, so ``before`` has fewer rows than there are
    # partitions: the broadcast is bounded by the partition count, not by the data.
    same_piece = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*keys, "_part"]]
    joined = local.join(F.broadcast(before), same_piece, "left")
    return joined.select(
        *df.columns,
        *[_combine(kind, F.col(f"_before_{name}"), F.col(f"_here_{name}")).alias(name)
          for name, (kind, _) in running.items()],
    )


def hash_order(seed: int, *ids: Column) -> Column:
    """A reproducible random order: the md5 text of ``seed:id``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def hash_block(hashed: Column, digits: int = 4) -> Column:
    """First hex digits of a hash: equal-sized blocks that follow the order of the hash."""
    return F.substring(hashed, 1, digits)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float]) -> DataFrame:
    """Per key the smallest value that at least a share q of the rows do not exceed.

    Rows are first counted per distinct value (partial sums before the shuffle), then the counts run in range pieces, which
    follow the values wherever they lie dense; no task ever holds all values of a key.
    """
    counted = stage(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")), "counted")
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    placed = range_running(counted, keys, [F.col(value)], {"_upto": ("sum", F.col("_n"))})
    named = totals.select("_all", *[F.col(k).alias(f"_of_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    both = placed.join(named, same) if keys else placed.withColumn("_all", F.lit(counted.agg(F.sum("_n")).first()[0]))
    return both.groupBy(*keys).agg(
        *[F.min(F.when(F.col("_upto") >= F.ceil(F.lit(float(q)) * F.col("_all")), F.col(value)))
          .alias(f"p{round(q * 100)}") for q in quantiles]
    )
