"""The curate job at the published scale: about 20 million rows in 180 daily CSV folders.

    python bench_curate.py <sf dir> <work dir> [cores]

Copies of the ``events`` table under new ids stand in for the missing raw files. Writing them is
not timed; reading, removing duplicates, filtering, writing by day and the report are.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from millrace.operators import curate as C, features as X
from millrace.plans.standins import watch_events
from millrace.session import local_session


def main(sf_dir: str, work: str, cores: str = "8", rows_wanted: int = 20_010_929) -> None:
    spark = local_session(cores, "bench_curate")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(8, int(cores))))
    events = watch_events(spark, sf_dir)
    n = events.count()
    copies = -(-rows_wanted // n)
    raw = f"{work}/raw"
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    day = F.date_add("dt", (F.col("copy") % 6 * 30).cast("int"))
    many = many.select(
        (F.col("event_id") + F.col("copy") * n).alias("event_id"),
        (F.col("subscriber_id") + F.col("copy") * 1000).cast("int").alias("subscriber_id"), "content_id",
        day.alias("event_date"), "watch_minutes", "device", "completed", day.alias("dt"),
    )
    if not os.path.exists(raw):
        C.write_raw(many, raw)

    start = time.perf_counter()
    C.write_curated(C.curate(C.read_raw(spark, raw)), f"{work}/curated")
    clean = time.perf_counter() - start
    written = spark.read.parquet(f"{work}/curated")
    summary = C.curate_summary(written).first().asDict()
    curate = time.perf_counter() - start
    start = time.perf_counter()
    X.squash(C.recent_days(written, "2024-06-01")).write.format("noop").mode("overwrite").save()
    squash = time.perf_counter() - start
    sizes = {side: C.files_and_bytes(spark, f"{work}/{side}").first().asDict() for side in ("raw", "curated")}
    print(json.dumps({
        "rows_in": copies * n, "cores": cores, "curate_sec": round(curate, 2), "of_which_report_sec": round(curate - clean, 2), "rows_per_sec": round(copies * n / curate),
        "squash_30_days_sec": round(squash, 2), "summary": summary, "sizes": sizes,
    }))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
