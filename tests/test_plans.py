"""Plan shape: no Python evaluation, partial aggregation, pushdown, pruning."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from feedlake.operators import clean, dedupe, duplicate_keys, enrich, source_metrics
from feedlake.plans.registry import QUERIES
from feedlake.sinks import read_feed_table, write_combined
from feedlake.sources.fixture import listing_feed

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_evaluation_anywhere(spark):
    feed = listing_feed(spark, SF_SMALL)
    plans = [_plan(enrich(dedupe(clean(feed), order_by="all"), "t"))]
    for name in ("normalise_dates", "date_format_profile", "numeric_profile", "null_profile",
                 "category_profile", "quality_score", "validate_feeds", "duplicate_keys"):
        plans.append(_plan(QUERIES[name](spark, SF_SMALL)))
    for p in plans:
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_metrics_do_not_travel_with_the_ids(spark):
    """One wide aggregation per source, and one of (source, id) that holds the key columns only."""
    p = source_metrics(listing_feed(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    by_id = [line for line in p.splitlines() if "hashpartitioning(source_name" in line and "property_id" in line]
    assert by_id
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "HashAggregate(keys=[source_name" in line and "property_id" in line.split("functions")[0]:
            assert "count" in line and "neg" not in line and "min(" not in line
            assert line.split("functions=[")[1].split("]")[0].count(",") == 0
    assert p.count("Scan parquet") == 2


def test_scan_reads_only_needed_columns(spark):
    feed = listing_feed(spark, SF_SMALL)
    p = _plan(source_metrics(feed, numeric=[], null_columns=[]))
    assert "l_tax" not in p and "l_comment" not in p and "l_returnflag" not in p


def test_ordered_dedupe_has_partial_aggregation(spark):
    feed = clean(listing_feed(spark, SF_SMALL))
    p = _plan(dedupe(feed, order_by="all"))
    assert "partial_min" in p
    assert "Window" not in p


def test_top_k_limits_before_shuffle(spark):
    p = _optimized(duplicate_keys(listing_feed(spark, SF_SMALL), k=5))
    assert "WindowGroupLimit" in p


def test_partition_pruning_on_read_back(spark, tmp_dir):
    df = spark.createDataFrame([("a", "2025-01-06", "s1"), ("b", "2025-01-07", "s2")],
                               "id string, feed_date string, source_name string")
    path = os.path.join(tmp_dir, "c")
    write_combined(df, path)
    q = read_feed_table(spark, path).where(F.col("feed_date") == "2025-01-07")
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(feed_date" in p
    assert [r.id for r in q.collect()] == ["b"]


def test_profile_reports_do_not_rescan_raw_data(spark):
    from feedlake.plans.pipeline import profile

    feed = listing_feed(spark, SF_SMALL)
    prof = profile(feed)
    derived = [prof.stats, prof.schema, prof.numeric, prof.dates, prof.nulls,
               prof.categories, prof.scores, prof.overall]
    for frame in derived:
        assert "lineitem" not in _plan(frame)
    assert "lineitem" in _plan(prof.duplicates)
