"""Enrich cleaned rows (ratio, word case, ingestion time, leftovers)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import capitalise_words, price_per_sqft


def run_timestamp(now: datetime | None = None) -> str:
    """the processing time as ``yyyy-MM-dd HH:mm:ss`` UTC text."""
    now = now or datetime.now(timezone.utc)
    return now.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def enrich(df: DataFrame, ingestion_timestamp: str | None = None,
           source_name: str | None = None) -> DataFrame:
    """Add ``price_per_sqft`` (recomputed from clean price and sqft),
    capitalise the categorical columns, stamp ``ingestion_timestamp`` and drop
    leftover crawler columns. One projection; absent columns are skipped.

    ``ingestion_timestamp`` is a parameter so a run is reproducible; by
    default it is taken once, now. ``source_name`` sets that column to a
    literal (for a single-source frame that lacks it).
    """
    ts = ingestion_timestamp if ingestion_timestamp is not None else run_timestamp()
    updates: dict[str, Column] = {}
    if source_name is not None:
        updates[C.SOURCE_COL] = F.lit(source_name)
    updates[C.INGESTION_COL] = F.lit(ts)
    if "price" in df.columns and "sqft" in df.columns:
        updates["price_per_sqft"] = price_per_sqft(df["price"], df["sqft"])
    for name in C.INITCAP_COLUMNS:
        if name in df.columns:
            updates[name] = capitalise_words(df[name])
    return df.withColumns(updates).drop(*C.LEFTOVER_COLUMNS)
