"""Source validation (G1), isolation of failed sources (G4), ETL summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import is_negative_int, is_null_or_empty
from feedlake.operators.dedupe import duplicate_counts


def _count_if_present(df: DataFrame, column: str, pred) -> F.Column:
    if column in df.columns:
        return F.count_if(pred(column))
    return F.lit(0).cast("long")


def validate_feeds(df: DataFrame, sources: Iterable[str] | None = None,
                   errors: Mapping[str, str] | None = None) -> DataFrame:
    """G1 for every source in one aggregation.

    Per source: ``total_rows``, ``null_ids`` (null or empty id),
    ``duplicate_ids``, ``negative_prices`` and ``negative_sqft`` (integer
    meaning of the raw text). A source fails when it has no rows, or else when
    it has null ids; the other counts only inform. ``sources`` (a registry)
    adds sources without rows; ``errors`` adds sources that could not be read.

    Columns: source_name, total_rows, null_ids, duplicate_ids,
    negative_prices, negative_sqft, passed, message.
    """
    stats = first_measures(df)
    ids = duplicate_counts(df).withColumnRenamed(C.SOURCE_COL, "_ids_of")
    stats = stats.join(ids, F.col(C.SOURCE_COL).eqNullSafe(F.col("_ids_of"))).drop("_ids_of")
    return verdicts(stats, sources, errors)


def first_measures(df: DataFrame) -> DataFrame:
    """Per source the counts that are sums over rows: those of parts of a feed add up."""
    return df.groupBy(C.SOURCE_COL).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_null_or_empty(C.KEY_COL)).alias("null_ids"),
        _count_if_present(df, "price", is_negative_int).alias("negative_prices"),
        _count_if_present(df, "sqft", is_negative_int).alias("negative_sqft"),
    )


def verdicts(stats: DataFrame, sources: Iterable[str] | None = None,
             errors: Mapping[str, str] | None = None) -> DataFrame:
    """The validation frame from a source's counts (see :func:`validate_feeds`)."""
    src, spark = C.SOURCE_COL, stats.sparkSession
    if sources is not None:
        registry = spark.createDataFrame([(s,) for s in dict.fromkeys(sources)], f"{src} string")
        stats = registry.join(stats, src, "left").fillna(
            0, ["total_rows", "null_ids", "duplicate_ids", "negative_prices", "negative_sqft"])
    msg = (F.when(F.col("total_rows") == 0,
                  F.format_string(C.MSG_NO_RECORDS.replace("{source}", "%s"), F.col(src)))
            .when(F.col("null_ids") > 0,
                  F.format_string(C.MSG_NULL_IDS.replace("{source}", "%s").replace("{n}", "%d"),
                                  F.col(src), F.col("null_ids"))))
    out = stats.withColumns({"message": msg}).withColumn("passed", F.col("message").isNull())
    if errors:
        failed = spark.createDataFrame(
            [(s, 0, 0, 0, 0, 0, False, m) for s, m in errors.items()],
            f"{src} string, total_rows long, null_ids long, duplicate_ids long, "
            "negative_prices long, negative_sqft long, passed boolean, message string")
        out = out.join(failed.select(src), src, "left_anti").unionByName(failed)
    return out.select(src, "total_rows", "null_ids", "duplicate_ids", "negative_prices",
                      "negative_sqft", "passed", "message")


def pipeline_summary(validation: DataFrame) -> DataFrame:
    """Source, raw row count (0 when failed), ``SUCCESS`` or ``FAILED: msg``."""
    passed = F.col("passed")
    return validation.select(
        C.SOURCE_COL,
        F.when(passed, F.col("total_rows")).otherwise(F.lit(0)).cast("long").alias("rows"),
        F.when(passed, F.lit(C.STATUS_SUCCESS))
         .otherwise(F.concat(F.lit(C.STATUS_FAILED_PREFIX), F.col("message"))).alias("status"),
    )


def keep_passing(df: DataFrame, validation: DataFrame) -> DataFrame:
    """Keep only rows of sources that passed validation.

    A semi-join on the validation frame, one row per source. Pass it stored
    (see ``session.stored_copy``): its size is known then, and Spark decides
    whether to broadcast it.
    """
    return df.join(validation.where("passed").select(C.SOURCE_COL), C.SOURCE_COL, "left_semi")
