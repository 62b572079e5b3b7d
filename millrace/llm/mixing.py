"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.sizing import computed_once, small_side
from millrace.sources.staging import stage

#: Runs of anything but the ASCII white space (fixed pattern).
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source are dealt to this many ranges of a hash; at most one range of a source is put in order.
RANGES = 1 << 12


def words_in(text: Column) -> Column:
    """The number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weight_by_rank(weights: list[int], rank: Column) -> Column:
    """The weights in turn, repeating; ``rank`` counts from 1."""
    return F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))


def targets(sizes: DataFrame, weights: list[int], epochs: int) -> DataFrame:
    """Adds ``target`` to (source, source_size), one row per source.

    Sources share the total of all sizes by weight, but none takes more than ``epochs`` times its own size;
    the excess goes to the others by weight, over and over. A source is full before another one if its size
    per weight is smaller. So in that order the full ones are a prefix: a source stays full as long as its
    share of what those before it leave is above its limit. The sources' sums are one row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    up = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    rest = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    cap = F.col("source_size") * F.lit(epochs)
    share = F.col("left") * F.col("weight") / F.col("weights")
    return (sizes.withColumn("weight", weight_by_rank(weights, F.row_number().over(order)))
            .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
            .withColumn("weights", F.sum("weight").over(rest))
            .withColumn("full", share >= cap)
            # the level of the first source that is not full holds for all after it
            .withColumn("level", F.first(F.when(~F.col("full"), F.col("left") / F.col("weights")), ignorenulls=True)
                        .over(everything))
            .select("source", "source_size",
                    F.when(F.col("full"), cap.cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target")))


def mix(docs: DataFrame, weights: list[int] | None = None, epochs: int = 3, seed: int = 7,
        carry: list[str] | None = None) -> DataFrame:
    """How often the mix takes each document: every column of ``carry`` (default doc_id), and size,
    source_size, target, repeats (how many times the document is taken) and taken (repeats x size).

    A source that must give e times its size gives each document floor(e) times, and some once more: in the
    order of a seeded hash, documents are taken until the remainder is reached; the last one counts if that
    brings the sum nearer. So each source is within half a document of its target, and nobody is taken
    more than ``epochs`` times. The order is found without sorting a source: sums by hash range tell which
    ranges are taken whole and which is not, and only documents of that range are put in order.

    Null and empty texts have size 0 and are taken as often as their source's whole repetitions. A null source
    is a source of its own, the last one. Repeated rows each count. Rows that agree in doc_id and text are
    interchangeable. Reruns agree: nothing depends on partitions. An empty table gives an empty result.
    Only DataFrame functions are used. Columns that are not carried play no part, whatever their names. Sources are rows of one window: there
    may be many, as long as a task can sort their sums.
    """
    return _mixed(docs, weights or [5, 2, 1], epochs, seed, carry or ["doc_id"]).select(
        "row.*", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def _mixed(docs: DataFrame, weights: list[int], epochs: int, seed: int, carry: list[str]) -> DataFrame:
    """(row, size, source_size, target, repeats); row holds the carried columns, so no name can clash."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                              F.md5(F.coalesce("text", F.lit("")))))
    sized = docs.select(F.struct(*carry).alias("row"), F.col("source").alias("src"), "text", drawn.alias("draw"))
    sized = computed_once(sized, "size", words_in(F.col("text"))).select(
        "row", "src", "size", "draw", (F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") % RANGES).alias("range"))
    ranges = sized.groupBy("src", "range").agg(F.sum("size").alias("range_size"))
    plan = targets(ranges.groupBy(F.col("src").alias("source")).agg(F.sum("range_size").alias("source_size")), weights, epochs)
    epoch = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (plan.withColumn("whole", F.floor(epoch).cast("long"))
            .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size")))
    # in each source, the range in which the remainder ends: the first that does not fit as a whole
    upto = Window.partitionBy("src").orderBy("range")
    ends = (ranges.withColumn("before", F.sum("range_size").over(upto) - F.col("range_size"))
            .join(plan, F.col("src").eqNullSafe(F.col("source")))
            .where(F.col("before") + F.col("range_size") > F.col("extra"))
            .groupBy("source").agg(F.min(F.struct("range", "before")).alias("end")))
    plan = plan.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", "extra", F.coalesce("end.range", F.lit(-1)).alias("end"), "end.before")
    joined = sized.join(small_side(stage(plan, "mix-plan")), F.col("src").eqNullSafe(F.col("source")))
    keep = ["row", "size", "source_size", "target"]
    sure = joined.where("range <> end").select(
        *keep, (F.col("whole") + F.when(F.col("range") < F.col("end"), 1).otherwise(0)).alias("repeats"))
    order = Window.partitionBy("source").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2
    cut = (joined.where("range = end").withColumn("once", (F.col("size") > 0) & (middle <= F.col("extra")))
           .select(*keep, (F.col("whole") + F.col("once").cast("int")).alias("repeats")))
    return sure.union(cut)


def repeated(docs: DataFrame, weights: list[int] | None = None, epochs: int = 3, seed: int = 7) -> DataFrame:
    """The documents of the mix, in the columns of ``docs``: each row as often as the mix takes it."""
    taken = _mixed(docs, weights or [5, 2, 1], epochs, seed, docs.columns)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))
    return taken.where("repeats > 0").select("row", times.alias("time")).select("row.*")
