"""Shards of near equal bytes by Karmarkar-Karp differencing over groups that stay together."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.sources.staging import stage


def difference(rows: list[tuple[int, ...]]) -> tuple[list[tuple[int, ...]], tuple[int, ...]]:
    """Karmarkar-Karp over partial partitions, each the sums of its shards.

    Of two partial partitions with the largest spread, the heaviest shard of one is laid upon the lightest
    of the other, and so on, until one is left. Returns for each row which shard of the final partition
    each of its own shards went to, and the final sums.
    """
    k = len(rows[0])
    heap, links, sums = [], [], list(rows)
    for i, row in enumerate(rows):
        heapq.heappush(heap, (min(row) - max(row), i))
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        down = sorted(range(k), key=lambda s: -sums[a][s])
        up = sorted(range(k), key=lambda s: sums[b][s])
        new = tuple(sums[a][x] + sums[b][y] for x, y in zip(down, up))
        links.append((a, b, down, up))
        sums.append(new)
        heapq.heappush(heap, (min(new) - max(new), len(sums) - 1))
    where: list = [None] * len(sums)
    where[-1] = tuple(range(k))
    for n in range(len(links) - 1, -1, -1):
        a, b, down, up = links[n]
        here, to_a, to_b = where[len(rows) + n], [0] * k, [0] * k
        for at, (x, y) in enumerate(zip(down, up)):
            to_a[x] = to_b[y] = here[at]
        where[a], where[b] = to_a, to_b
    return where[:len(rows)], sums[-1]


def _halves(shards: int):
    """Every task differences its own groups; out come its groups with a shard of its own partial partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, task = [], [], None
        for batch in batches:
            if batch.num_rows:
                keys.append(batch.column("grp"))
                sizes.append(batch.column("size").to_numpy())
                task = batch.column("task")[0].as_py() if task is None else task
        if not keys:
            return
        size = np.concatenate(sizes)
        where, _ = difference([(int(x), *[0] * (shards - 1)) for x in size])
        part = np.array([w[0] for w in where], np.int32)
        keys = pa.concat_arrays(keys)
        for at in range(0, len(part), 100_000):
            n = len(part[at:at + 100_000])
            yield pa.RecordBatch.from_arrays(
                [keys.slice(at, n), pa.array(size[at:at + n]), pa.array(np.full(n, task, np.int32)), pa.array(part[at:at + n])],
                ["grp", "size", "task", "part"])
    return run


def shard_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(grp, shard) for groups (grp, size), their bytes near equal.

    First each task differences the groups it holds to one partial partition, then those partitions, one row
    per task, are differenced with each other. Groups are never split, so one that exceeds a fair share
    leaves the shards as even as it allows.
    """
    spark = groups.sparkSession
    pieces = groups.rdd.getNumPartitions()
    local = stage(groups.withColumn("task", F.spark_partition_id())
                  .mapInArrow(_halves(shards), "grp binary, size long, task int, part int"), "halves")
    sums = local.groupBy("task").pivot("part", list(range(shards))).agg(F.sum("size")).fillna(0).orderBy("task").collect()
    assert len(sums) <= pieces  # one row per task, however many groups there are
    if not sums:
        return local.select("grp", F.col("part").alias("shard"))
    where, _ = difference([tuple(r[1:]) for r in sums])
    moves = spark.createDataFrame([(r.task, part, shard) for r, w in zip(sums, where) for part, shard in enumerate(w)],
                                  "task int, part int, shard int")
    return local.join(F.broadcast(moves), ["task", "part"]).select("grp", "shard")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the rows of each shard within a task."""
    seen: dict[int, int] = {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        slot = np.empty(len(shard), np.int64)
        for s in np.unique(shard).tolist():
            at = shard == s
            first = seen.get(s, 0)
            seen[s] = first + int(at.sum())
            slot[at] = np.arange(first, seen[s])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slot)], [*batch.schema.names, "nth"])


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in shards 0 to ``shards`` - 1 of near equal bytes, equal texts together.

    Returns doc_id, size (UTF-8 bytes of the text and 1), text_crc32 (unsigned), law ('bytes'), shard, slot (place
    within the shard, gapless from 0) and grown_shard (null: adding a shard would move rows freely). A null
    text has no bytes; it is a group of its own beside the empty text. Every row gets a slot, repeated rows
    and rows without doc_id too. An empty table gives an empty result. Other columns, whatever their
    names, play no part.
    """
    text = F.col("text")
    # null and empty texts differ by the first byte
    key = F.when(text.isNull(), F.lit(b"\x00")).otherwise(F.unhex(F.md5(text)))
    sized = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), key.alias("grp")), "sized")
    groups = stage(sized.groupBy("grp").agg(F.sum("size").alias("size")), "groups")
    placed = sized.join(shard_groups(groups, shards), "grp").select("doc_id", "size", "text_crc32", "shard")
    # the join's tasks number their own rows; written down, as a task that runs again may see another order
    counted = placed.withColumn("task", F.spark_partition_id())
    schema = "doc_id long, size long, text_crc32 long, shard int, task int, nth long"
    counted = stage(counted.mapInArrow(_numbered, schema), "numbered")
    tasks = counted.groupBy("shard", "task").count()
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = tasks.select("shard", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    return counted.join(F.broadcast(first), ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("nth")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
