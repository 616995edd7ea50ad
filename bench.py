"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default: all below),
``BENCH_REPEAT`` (default 1: one cold run per query; N > 1 reports the best of N).

Each query runs to completion through the ``noop`` sink (no driver collect);
its time includes any actions the query itself needs (the validation gate,
writes). One warm-up query runs first and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "feed_counts_by_source_date",
    "feed_counts_pivot",
    "normalise_dates",
    "date_format_profile",
    "clean_listings",
    "enrich_listings",
    "dedupe_first",
    "duplicate_keys",
    "validate_feeds",
    "numeric_profile",
    "null_profile",
    "category_profile",
    "quality_score",
    "quality_overall",
    "schema_check",
    "source_stats",
    "combine_sources",
    "pipeline_summary",
    "date_format_labels",
    "csv_feed_scores",
    "profile_scores",
    "profile_date_formats",
    "profile_categories",
    "date_samples",
    "combined_totals",
    "parquet_roundtrip",
    "table_counts",
    "incremental_load",
    "wide_quality_score",
    "wide_null_profile",
    "wide_numeric_profile",
    "wide_enrich",
    "etl_after_failure",
    "ordered_ids",
    "wide_categories",
    "merged_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))

    from feedlake.plans.registry import QUERIES as FEED
    from feedlake.plans.wide_registry import WIDE_QUERIES
    from feedlake.session import build_session

    spark = build_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(max(8, 2 * cpus)),
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    QUERIES = {**FEED, **WIDE_QUERIES}  # noqa: N806
    QUERIES["source_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "repeat": repeat,
        "fixture_rows": spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
