"""Quality score, grade and advice."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions.numbers import round_half_even_exact
from feedlake.operators.profile import (
    ColumnsBySource,
    missing_column_count,
    source_metrics,
)

_SCORE_SCHEMA = (f"{C.SOURCE_COL} string, rows long, null_ids long, duplicate_ids long, "
                 "missing_columns int, negative_prices long, negative_sqft long, score int, "
                 "grade string, icon string, issues string, status string")


def grade(score: Column) -> Column:
    """EXCELLENT / GOOD / FAIR / POOR by threshold."""
    expr = None
    for threshold, name in C.GRADES:
        cond = score >= threshold
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(C.GRADE_POOR))


def grade_icon(g: Column) -> Column:
    """Check mark for EXCELLENT/GOOD, warning sign for FAIR, else a cross."""
    return (F.when(g.isin("EXCELLENT", "GOOD"), F.lit(C.ICON_OK))
             .when(g == "FAIR", F.lit(C.ICON_WARN))
             .otherwise(F.lit(C.ICON_BAD)))


def quality_scores(df: DataFrame, columns_by_source: ColumnsBySource | None = None,
                   errors: Mapping[str, str] | None = None,
                   metrics: DataFrame | None = None) -> DataFrame:
    """A11-A13 per source from one aggregation.

    Start at 100; null ids -30, duplicate ids -20, any missing expected column
    -20, any negative price -5, any negative sqft -5 (double meaning); floor 0.
    Deductions are per kind, not per row. Sources that could not be read, or
    whose header lacks ``property_id``, score 0 with grade ERROR.
    """
    errors = dict(errors or {})
    if columns_by_source:
        for s, cols in columns_by_source.items():
            if C.KEY_COL not in cols and s not in errors:
                errors[s] = f"missing column {C.KEY_COL}"
    m = metrics if metrics is not None else source_metrics(df, numeric=("price", "sqft"),
                                                           null_columns=[])
    if errors:
        m = m.where(~F.col(C.SOURCE_COL).isin(list(errors)))

    def neg(c: str) -> Column:
        name = f"neg__{c}"
        return F.col(name).cast("long") if name in m.columns else F.lit(0).cast("long")

    has_key = C.KEY_COL in df.columns
    null_ids = F.col("null_ids").cast("long") if has_key else F.lit(None).cast("long")
    dup_ids = F.col("duplicate_ids").cast("long") if has_key else F.lit(None).cast("long")
    base = m.select(
        C.SOURCE_COL,
        F.col("rows").cast("long").alias("rows"),
        null_ids.alias("null_ids"),
        dup_ids.alias("duplicate_ids"),
        missing_column_count(df, columns_by_source).cast("int").alias("missing_columns"),
        neg("price").alias("negative_prices"),
        neg("sqft").alias("negative_sqft"),
    )
    checks = [
        (F.col("null_ids") > 0, C.DEDUCT_NULL_IDS, "Null property IDs"),
        (F.col("duplicate_ids") > 0, C.DEDUCT_DUPLICATE_IDS, "Duplicate IDs"),
        (F.col("missing_columns") > 0, C.DEDUCT_MISSING_COLUMNS, "Missing columns"),
        (F.col("negative_prices") > 0, C.DEDUCT_NEGATIVE, "Negative price"),
        (F.col("negative_sqft") > 0, C.DEDUCT_NEGATIVE, "Negative sqft"),
    ]
    deduction = sum((F.when(F.coalesce(cond, F.lit(False)), pts).otherwise(0)
                     for cond, pts, _ in checks), F.lit(0))
    issues = F.concat_ws("; ", *[F.when(F.coalesce(cond, F.lit(False)), F.lit(f"{label} (-{pts})"))
                                 for cond, pts, label in checks])
    score = F.greatest(F.lit(0), F.lit(C.SCORE_START) - deduction).cast("int")
    scored = (base.withColumn("score", score)
                  .withColumn("grade", grade(F.col("score")))
                  .withColumn("icon", grade_icon(F.col("grade")))
                  .withColumn("issues", issues)
                  .withColumn("status", F.lit(C.STATUS_PROFILED)))
    if errors:
        failed = df.sparkSession.createDataFrame(
            [(s, 0, None, None, None, None, None, 0, C.GRADE_ERROR, C.ICON_BAD, "",
              C.STATUS_FAILED_PREFIX + msg) for s, msg in errors.items()], _SCORE_SCHEMA)
        scored = scored.unionByName(failed)
    return scored


def quality_overall(scores: DataFrame) -> DataFrame:
    """A14 + G8: total rows, mean source score (1 decimal, Python's
    rounding; failed sources count as 0), overall grade and the go / no-go
    advice. One row."""
    agg = scores.agg(F.sum("rows").cast("long").alias("total_rows"),
                     F.count(F.lit(1)).cast("long").alias("sources"),
                     round_half_even_exact(F.avg("score"), 1).alias("avg_score"))
    avg = F.col("avg_score")
    advice = (F.when(avg >= C.ADVICE_SAFE_AT, F.lit(C.ADVICE_SAFE))
               .when(avg >= C.ADVICE_REVIEW_AT, F.lit(C.ADVICE_REVIEW))
               .otherwise(F.lit(C.ADVICE_STOP)))
    return agg.select("total_rows", "sources", F.coalesce(avg, F.lit(0.0)).alias("avg_score"),
                      grade(F.coalesce(avg, F.lit(0.0))).alias("grade"), advice.alias("advice"))
