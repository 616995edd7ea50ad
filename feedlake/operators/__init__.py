"""DataFrame -> DataFrame operators; every one carries ``source_name``."""

from feedlake.operators.clean import clean
from feedlake.operators.combine import combine_sources
from feedlake.operators.counts import feed_counts, feed_totals, pivot_counts
from feedlake.operators.dedupe import dedupe, duplicate_keys
from feedlake.operators.enrich import enrich, run_timestamp
from feedlake.operators.ordered import rank_within
from feedlake.operators.profile import (
    category_profile,
    date_format_profile,
    null_profile,
    numeric_profile,
    schema_check,
    source_metrics,
    source_stats,
)
from feedlake.operators.score import quality_overall, quality_scores
from feedlake.operators.topk import top_k_per_group
from feedlake.operators.validate import (
    keep_passing,
    pipeline_summary,
    validate_feeds,
)

__all__ = [
    "category_profile", "clean", "combine_sources", "date_format_profile", "dedupe",
    "duplicate_keys", "enrich", "feed_counts", "feed_totals", "keep_passing",
    "null_profile", "numeric_profile", "pipeline_summary", "pivot_counts",
    "quality_overall", "quality_scores", "rank_within", "run_timestamp", "schema_check", "source_metrics",
    "source_stats", "top_k_per_group", "validate_feeds",
]
