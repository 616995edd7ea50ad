"""G9 on a store: what a run over new feeds does, from reading to SQL.

``run_store`` is the daily run: it adds a feed's new rows to a ``FeedStore``, keeps the
malformed ones aside, points the SQL table to the new version and reports like
``run_etl``. Every step can be repeated after a stop: the store goes on at the
first stage that isn't done, and the other steps replace what they wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.operators import feed_counts, feed_totals, pipeline_summary
from feedlake.session import stored_copy
from feedlake.sinks.versions import register_version
from feedlake.sources import FeedSet, malformed_counts, quarantine
from feedlake.streaming.store import FeedStore


@dataclass
class StoreResult:
    """``summary`` is G5 with the number of this run's malformed rows; ``counts`` Q1; ``totals`` A18."""

    batch: int
    validation: DataFrame
    summary: DataFrame
    counts: DataFrame
    totals: DataFrame
    quarantine: DataFrame | None


def run_store(feeds: FeedSet, store: FeedStore, batch: int | None = None, ingestion_timestamp: str | None = None,
              table: str | None = None, input_version: str = "") -> StoreResult:
    """Add the rows of ``feeds`` to ``store`` as a batch and report. Sources that could not be read
    are reported as failed; what the table has of them stays."""
    spark = store.spark
    rows = feeds.df if feeds.df is not None else store.conform(spark.createDataFrame([], f"{C.SOURCE_COL} string"))
    batch = store.apply(rows, batch, ingestion_timestamp, input_version)
    kept = None
    if feeds.malformed is not None:
        kept = quarantine(feeds, f"{store.root.rstrip('/')}/quarantine/batch={batch}")
    validation = stored_copy(store.validation(batch, feeds.sources or None, feeds.errors), "validation")
    summary = pipeline_summary(validation)
    if kept is not None:
        bad = malformed_counts(kept)
        summary = summary.join(bad, C.SOURCE_COL, "left")
    else:
        summary = summary.withColumn("malformed_rows", F.lit(None).cast("long"))
    summary = summary.withColumn("malformed_rows", F.coalesce("malformed_rows", F.lit(0).cast("long")))
    if table:
        register_version(spark, table, store.root, store.schema)
    stored = store.read(batch)
    return StoreResult(batch, validation, summary, feed_counts(stored), feed_totals(stored), kept)
