"""Wall time of the headline queries.

Each query runs once to warm up, then ``BENCH_RUNS`` times; the median is
reported.  Results go to the ``noop`` sink, so every row is computed.  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

HEADLINE = (
    "raw_trends_timeseries", "twitter_daily", "reddit_daily", "trends_daily", "complaints_daily",
    "brand_daily_metrics", "composite_score", "unified_complaints", "complaint_text_features",
    "complaint_clusters", "cluster_summary", "daily_complaint_trends", "dashboard_summary",
    "complaint_page", "mention_detection", "mention_acceptance", "mention_positions", "normalised_complaints",
    "flattened_tweets", "latest_versions", "merge_events", "merge_trends", "most_duplicated", "enriched_texts",
    "plugged_scorer", "search_extract", "analysed_tokens", "relevance_match", "evidence_quotes", "hybrid_match",
    "nearest_vectors", "diverse_quotes", "share_of_voice", "quality_report", "upserted_table", "stream_upserted",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE

    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from pulsemart.plans.catalog import QUERIES
    from pulsemart.session import build_session

    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
           "spark.pulsemart.spreadPartitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    for name in chosen:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name:32s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
