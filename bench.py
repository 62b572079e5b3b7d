"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local
cores. Every query is written to a sink that takes all rows and keeps none. One untimed run warms
the JVM and the Python workers, the next one is timed.
"""

from __future__ import annotations

import json
import os
import re
import time

from millrace.plans import QUERIES
from millrace.session import local_session

HEADLINE = [
    # curate, aggregate, join
    "src_csv_events", "snk_parquet_by_day", "rpt_curate_summary", "scan_recent_days", "dedup_event_id", "agg_squash",
    "join_left_zero_fill", "agg_group_summary", "split_stratified", "ml_auc",
    # star schema
    "join_sales_by_country", "agg_top_artist", "agg_latency", "prof_columns", "agg_run_timing",
    # vectors and ranks
    "topk_search_score", "topk_retrieve", "topk_rerank", "join_query_corpus", "vec_embed", "win_nucleus", "rank_candidates",
    # text
    "txt_links", "txt_extract_tags", "txt_chunk_fixed", "txt_chunk_recursive", "txt_search_lexical", "txt_repeated_bigrams",
    "win_greedy_next", "txt_stream_join",
    # tool calls and conversations
    "json_convert_tools", "agg_tool_accuracy", "udf_tool_dispatch", "hist_prior_turns", "hist_until_terminate",
    # jobs
    "llm_rag_job", "ml_train_churn",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in HEADLINE:
        run(spark, sf_dir, name)
        seconds[name] = round(run(spark, sf_dir, name), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(sf.group(1)) if sf else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
