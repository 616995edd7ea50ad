"""Rows per source and day (A15, Q1) and the same laid out per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import config as C

# Q1 of the published report, over a table called ``{table}``.
Q1_SQL = """
SELECT source_name, feed_date, COUNT(*) AS rows
FROM {table}
GROUP BY source_name, feed_date
ORDER BY source_name, feed_date
"""


def feed_counts(df: DataFrame, by: str | Column = "feed_date") -> DataFrame:
    """A15 + L2: ``rows`` per (source_name, ``by``), ordered by both.

    ``by`` may be an expression (e.g. the year of ``feed_date``); the output
    column keeps its name. Partial aggregation runs before the shuffle, so a
    hot source or day costs one row per map task.
    """
    key = F.col(by) if isinstance(by, str) else by
    name = by if isinstance(by, str) else "bucket"
    return (df.groupBy(C.SOURCE_COL, key.alias(name))
              .agg(F.count(F.lit(1)).alias("rows"))
              .orderBy(F.col(C.SOURCE_COL).asc_nulls_first(), F.col(name).asc_nulls_first()))


def pivot_counts(counts: DataFrame, column: str, values: Sequence | None = None,
                 value_col: str = "rows") -> DataFrame:
    """One row per source, one column per value of ``column``.

    Meant for the small output of :func:`feed_counts` (ideally checkpointed),
    so finding the pivot values when ``values`` is not given scans that small
    frame, not the feed. Absent combinations are 0.
    """
    grouped = counts.groupBy(C.SOURCE_COL)
    pivoted = (grouped.pivot(column, list(values)) if values is not None
               else grouped.pivot(column)).agg(F.sum(value_col))
    value_cols = [c for c in pivoted.columns if c != C.SOURCE_COL]
    return (pivoted.fillna(0, value_cols)
                   .select(C.SOURCE_COL, *[F.col(f"`{c}`").cast("long").alias(c) for c in value_cols])
                   .orderBy(C.SOURCE_COL))


def feed_totals(df: DataFrame) -> DataFrame:
    """One row with the total row count and the number of (source,
    feed_date) partitions of a combined table (or of any feed frame)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_distinct(F.col(C.SOURCE_COL), F.coalesce(F.col("feed_date"), F.lit("")))
                  .alias("partitions"))
