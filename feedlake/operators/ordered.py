"""L1: values in order with their rank, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.session import stored_copy


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                rank_col: str = "rank", parts: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) in its group, in ascending order of ``order_cols``, nulls
    first; rows that tie have places of their own, which of them first is not defined.

    Rows are dealt by ranges over group and order to ``parts`` tasks (default:
    the shuffle partitions), so a group with many rows goes to many. A row's
    place is its place within its range plus the number of the group's rows in
    the ranges before, a table of one row per group and range.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups, order = list(group_cols), [F.col(c).asc_nulls_first() for c in order_cols]
    names = df.columns
    span, inner, before, total = (_unused(names, c) for c in ("span", "inner", "before", "total"))
    # Stored once: the bounds of the ranges come from a sample.
    placed = stored_copy(df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in groups], *order)
                           .withColumn(span, F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*groups).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(*groups, span).agg(F.count(F.lit(1)).alias(total))
                     .withColumn(before, F.coalesce(F.sum(total).over(earlier), F.lit(0))))
    offsets = offsets.select(F.struct(*groups, span).alias(inner + "key"), F.col(before))
    here = Window.partitionBy(*groups, span).orderBy(*order)
    ranked = placed.withColumn(inner, F.row_number().over(here)).withColumn(inner + "key", F.struct(*groups, span))
    on = F.lit(True)
    for c in (*groups, span):
        on = on & ranked[inner + "key"][c].eqNullSafe(offsets[inner + "key"][c])
    return ranked.join(offsets, on).select(*names, (F.col(before) + F.col(inner)).cast("long").alias(rank_col))


def _unused(names: Sequence[str], name: str) -> str:
    known = {c.lower() for c in names}
    name = f"__{name}"
    while name in known:
        name += "_"
    return name
