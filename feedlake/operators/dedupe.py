"""Duplicate keys: count (A3), remove (A4) and sample (A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.operators.topk import top_k_per_group

DEFAULT_KEYS: tuple[str, ...] = (C.SOURCE_COL, C.KEY_COL)


def id_counts(df: DataFrame, key: str = C.KEY_COL, group_col: str = C.SOURCE_COL) -> DataFrame:
    """``n``: the rows per (group, id)."""
    return df.groupBy(group_col, key).agg(F.count(F.lit(1)).alias("n"))


def duplicate_counts(df: DataFrame, key: str = C.KEY_COL, group_col: str = C.SOURCE_COL,
                     ids: DataFrame | None = None) -> DataFrame:
    """A3 per group: ``duplicate_ids``, rows minus distinct keys (null is a key). Ids are counted once per (group, id),
    so a hot group spreads over all reducers, and then summed. ``ids``: these counts, if they are there."""
    once = id_counts(df, key, group_col) if ids is None else ids
    return once.groupBy(group_col).agg(F.sum(F.col("n") - 1).cast("long").alias("duplicate_ids"))


def dedupe(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
           order_by: Sequence[str] | str | None = None) -> DataFrame:
    """A4: one row per key.

    ``order_by=None`` keeps any one row (``dropDuplicates``). With a list of
    columns, or ``"all"``, it keeps the first row in ascending order (nulls
    first) of those columns followed by all other columns: a total order, so
    the result is deterministic and stable under task retries.

    The ordered form is ``min(struct(...))`` per key, an aggregate with a
    map-side partial step: a key held by millions of rows is reduced inside
    each map task before the shuffle, unlike a window over the key. Such an
    aggregate sorts by the key, and most rows differ in the last part (the id).
    """
    keys = list(keys)
    if order_by is None:
        return df.dropDuplicates(keys)
    values = [c for c in df.columns if c not in keys]
    first = [] if order_by == "all" else [c for c in order_by if c not in keys]
    ordered = first + [c for c in values if c not in first]
    best = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_first")
    return (df.groupBy(*reversed(keys)).agg(best)
              .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c)
                        for c in df.columns]))


def duplicate_keys(df: DataFrame, k: int = 5, key: str = C.KEY_COL,
                   group_col: str = C.SOURCE_COL) -> DataFrame:
    """A5: per source, keys seen more than once; the ``k`` most frequent
    (ties by key, nulls first). Columns: source, key, ``occurrences``, ``rank``.
    """
    counts = (df.groupBy(group_col, key).agg(F.count(F.lit(1)).alias("occurrences"))
                .where(F.col("occurrences") > 1))
    order = [F.col("occurrences").desc(), F.col(key).asc_nulls_first()]
    return top_k_per_group(counts, [group_col], order, k)
