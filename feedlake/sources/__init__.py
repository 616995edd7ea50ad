"""Sources: CSV feeds, the lineitem-derived fixture, stored tables."""

from feedlake.sinks.parquet import read_feed_table
from feedlake.sources.csv_feeds import (
    FeedSet,
    malformed_counts,
    quarantine,
    read_feed,
    read_feed_root,
    read_feed_scan,
    read_feeds,
    source_paths,
)
from feedlake.sources.fixture import listing_feed, listing_feed_from, listing_feed_sql

__all__ = [
    "FeedSet", "listing_feed", "listing_feed_from", "listing_feed_sql", "malformed_counts",
    "quarantine", "read_feed",
    "read_feed_root", "read_feed_scan", "read_feed_table", "read_feeds", "source_paths",
]
