"""Pipeline-level plans: process (G1-G4 + G2 + A4 + G3), profile (G7), run."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.operators import (
    clean,
    dedupe,
    duplicate_keys,
    enrich,
    feed_counts,
    feed_totals,
    keep_passing,
    null_profile,
    numeric_profile,
    pipeline_summary,
    quality_overall,
    quality_scores,
    schema_check,
    source_metrics,
    source_stats,
    validate_feeds,
)
from feedlake.operators.counts import Q1_SQL
from feedlake.operators.profile import (
    categories_from_values,
    date_samples,
    date_formats_from_values,
    schema_check_for_sources,
    value_counts,
)
from feedlake.session import ensure_checkpoint_dir, stored_copy
from feedlake.sinks import (
    OVERWRITE_MODES,
    add_table_partitions,
    drop_table_partitions,
    folders_of,
    path_exists,
    read_feed_table,
    register_table,
    remove_folders,
    rewrite_touched,
    write_feed,
)
from feedlake.streaming.incremental import date_filter

log = logging.getLogger(__name__)


def process(df: DataFrame, validation: DataFrame | None = None,
            ingestion_timestamp: str | None = None, dedupe_order: Sequence[str] | str | None = "all",
            sqft_threshold: float = C.SQFT_PLACEHOLDER_THRESHOLD) -> DataFrame:
    """Validated, cleaned, deduplicated and enriched rows of passing sources.

    Failing sources are left out (G4); the rest are one plan. The dedupe is
    per source across all dates and, by default, keeps the first row in a
    total order, so reruns and task retries give the same rows.
    """
    if validation is None:
        validation = stored_copy(validate_feeds(df), "validation")
    good = keep_passing(df, validation)
    cleaned = clean(good, sqft_threshold)
    unique = dedupe(cleaned, order_by=dedupe_order)
    return enrich(unique, ingestion_timestamp)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a small result in the shared checkpoint folder (cuts lineage)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@dataclass
class Profile:
    """G7 for all sources: report frames derived without rescans.

    The per-source metrics and the per-value counts are each stored on first
    use; every report reads only the one it needs, so a caller reading the
    scores alone, or the dates alone, pays for one raw pass.
    """

    feed: DataFrame
    columns_by_source: Mapping[str, Sequence[str]] | None = None
    errors: Mapping[str, str] | None = None
    extended_dates: bool = False

    @cached_property
    def metrics(self) -> DataFrame:
        return stored_copy(source_metrics(self.feed), "metrics")

    @cached_property
    def values(self) -> DataFrame:
        return stored_copy(value_counts(self.feed, extended=self.extended_dates,
                                        columns_by_source=self.columns_by_source), "values")

    @property
    def stats(self) -> DataFrame:
        return source_stats(self.feed, self.columns_by_source, metrics=self.metrics)

    @property
    def schema(self) -> DataFrame:
        if self.columns_by_source:
            return schema_check(self.feed, self.columns_by_source)
        return schema_check_for_sources(self.metrics, [c for c in self.feed.columns if c != C.SOURCE_COL])

    @property
    def duplicates(self) -> DataFrame:
        return duplicate_keys(self.feed)

    @property
    def numeric(self) -> DataFrame:
        return numeric_profile(self.feed, columns_by_source=self.columns_by_source, metrics=self.metrics)

    @property
    def nulls(self) -> DataFrame:
        return null_profile(self.feed, columns_by_source=self.columns_by_source, metrics=self.metrics)

    @property
    def scores(self) -> DataFrame:
        return quality_scores(self.feed, self.columns_by_source, self.errors, metrics=self.metrics)

    @property
    def overall(self) -> DataFrame:
        return quality_overall(self.scores)

    @property
    def dates(self) -> DataFrame:
        return date_formats_from_values(self.values)

    @property
    def categories(self) -> DataFrame:
        return categories_from_values(self.values)

    @property
    def date_samples(self) -> DataFrame:
        return date_samples(self.values)


def profile(df: DataFrame, columns_by_source: Mapping[str, Sequence[str]] | None = None,
            errors: Mapping[str, str] | None = None, extended_dates: bool = False) -> Profile:
    """Profile every source in at most three passes over the raw data: the
    per-source metrics, the per-value counts (each on first use) and the
    duplicate-key sample. Every other frame is reshaped from those results."""
    return Profile(df, columns_by_source, errors, extended_dates)


@dataclass
class EtlResult:
    validation: DataFrame
    summary: DataFrame
    sources_path: str | None
    combined_path: str | None
    table: str | None
    counts: DataFrame | None
    totals: DataFrame | None = None


def quality_gate(validation: DataFrame, scores: DataFrame, min_score: float) -> DataFrame:
    """``validation`` with the sources that score below ``min_score`` failed, with the reason."""
    low = scores.where(F.col("score") < min_score).select(
        C.SOURCE_COL, F.concat(F.lit("QUALITY GATE ["), F.col(C.SOURCE_COL), F.lit("]: score "),
                               F.col("score").cast("string"), F.lit(f" below {min_score:g}")).alias("_low"))
    return (validation.join(low, C.SOURCE_COL, "left")
                      .withColumn("message", F.coalesce("_low", "message"))
                      .withColumn("passed", F.col("passed") & F.col("_low").isNull()).drop("_low"))


def _store(processed: DataFrame, path: str, partition_by: Sequence[str], overwrite: str,
           keep: F.Column | None, once: bool = True) -> tuple[DataFrame | None, DataFrame | None]:
    """Write a full load, or bring the stored table up to date; the folders written and removed
    (None: all were written). ``once``: see :func:`rewrite_touched`."""
    if overwrite == "static" or not path_exists(processed.sparkSession, path):
        write_feed(processed if keep is None else processed.where(keep), path, partition_by, overwrite="static", deal=once)
        return None, None
    return rewrite_touched(processed, path, partition_by, keep, once=once)


def run_etl(df: DataFrame, out_root: str, sources: Sequence[str] | None = None,
            errors: Mapping[str, str] | None = None, ingestion_timestamp: str | None = None,
            dates: Sequence[str] | F.Column | None = None, table: str | None = None,
            overwrite: str = "dynamic", min_score: float | None = None,
            columns_by_source: Mapping[str, Sequence[str]] | None = None) -> EtlResult:
    """G9 after profiling: validate, process, store per source (K1), combine
    (K2) from the stored rows, register the table (K3) and run Q1.

    ``overwrite='static'`` replaces everything stored. With ``'dynamic'`` the
    folders that hold an id of this run, before or after it, are rewritten and
    the others stay, so an id is never stored twice. ``dates`` limits that to
    ids with a row on those normalised feed dates (I1); it cannot go with
    ``'static'``, which would erase the other dates. Sources that fail are not
    in the combined table, also if an earlier run stored them. ``min_score``
    (off by default) turns the profiler's advice into a gate: sources scoring
    below it are recorded as failed and left out.
    """
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"overwrite must be one of {OVERWRITE_MODES}")
    keep = date_filter(dates)
    if keep is not None and overwrite == "static":
        raise ValueError("dates with overwrite='static' would erase every other date; use 'dynamic'")
    spark = df.sparkSession
    validation = validate_feeds(df, sources, errors)
    if min_score is not None:
        validation = quality_gate(validation, quality_scores(df, columns_by_source), min_score)
    validation = stored_copy(validation, "validation")
    summary = pipeline_summary(validation)
    passed, failed = validation.where("passed").select(C.SOURCE_COL), validation.where("NOT passed").select(C.SOURCE_COL)
    processed = process(df, validation, ingestion_timestamp)
    sources_path = os.path.join(out_root, "processed")
    combined_path = os.path.join(out_root, "combined")
    layout = ("feed_date", C.SOURCE_COL)
    if not passed.take(1):
        log.warning("no source passed validation; nothing written")
        return EtlResult(validation, summary, None, None, None, None)
    _store(processed, sources_path, (C.SOURCE_COL, "feed_date"), overwrite, keep)
    stored = read_feed_table(spark, sources_path, processed.schema, partition_by=(C.SOURCE_COL, "feed_date"))
    stored = stored.join(passed, C.SOURCE_COL, "left_semi").select(*processed.columns)
    written, gone = _store(stored, combined_path, layout, overwrite, keep, once=False)
    counts = None
    if written is not None:
        combined = read_feed_table(spark, combined_path, processed.schema)
        left_out = combined.join(failed, C.SOURCE_COL, "left_semi").select(*layout).distinct()
        gone = stored_copy(gone.unionByName(left_out), "gone")
        remove_folders(spark, stored_copy(folders_of(combined, failed, [C.SOURCE_COL]), "doomed"))
    if table:
        if written is not None and spark.catalog.tableExists(table):
            # Name only the folders of this run (no full listing).
            add_table_partitions(spark, table, written)
            drop_table_partitions(spark, table, gone)
            spark.catalog.refreshTable(table)
        else:
            register_table(spark, table, combined_path, processed.schema)
        counts = spark.sql(Q1_SQL.format(table=table))
    totals = feed_totals(read_feed_table(spark, combined_path, processed.schema))
    return EtlResult(validation, summary, sources_path, combined_path, table, counts, totals)


def q1_counts(spark: SparkSession, table_or_path: str) -> DataFrame:
    """Q1 over a registered table, or over a combined Parquet path."""
    if "/" in table_or_path:
        df = read_feed_table(spark, table_or_path)
        return feed_counts(df)
    return spark.sql(Q1_SQL.format(table=table_or_path))
