"""Queries over the wide fixture and whole runs, with oracles of literals.

The oracle texts share no values with ``config`` and no arithmetic with
``functions``: thresholds, labels and column lists are written out here, and
rounding is plain decimal arithmetic on the integer counts.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.dates import normalise_date_columns
from feedlake.operators import (
    category_profile,
    clean,
    combine_sources,
    enrich,
    feed_counts,
    null_profile,
    numeric_profile,
    pipeline_summary,
    pivot_counts,
    quality_overall,
    quality_scores,
    rank_within,
    schema_check,
    validate_feeds,
)
from feedlake.plans.daily_profile import MergedProfile, ProfileStore
from feedlake.plans.pipeline import process, run_etl
from feedlake.plans.registry import FEED_CTE, PROCESSED_CTES, RUN_TS, _norm_date
from feedlake.session import scratch_path, stored_copy
from feedlake.sinks import read_feed_table, write_source_folders, write_sources
from feedlake.sources.fixture import listing_feed
from feedlake.sources.wide_fixture import EMPTY_SOURCE, UNREADABLE, wide_columns, wide_feed, wide_feed_sql

Query = Callable[[SparkSession, str], DataFrame]


def q_wide_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11-A13 with every grade, per-source headers and an unreadable source."""
    feed = wide_feed(spark, sf_dir)
    return quality_scores(feed, wide_columns(feed), UNREADABLE)


def q_wide_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + G8: the three kinds of advice, on three choices of sources."""
    feed = wide_feed(spark, sf_dir)
    scores = stored_copy(quality_scores(feed, wide_columns(feed), UNREADABLE), "scores")
    picks = {"safe": ("w0", "w1", "w4"), "review": ("w1", "w2", "w3"), "stop": ("w2", "w3", "w9")}
    return combine_sources([quality_overall(scores.where(F.col("source_name").isin(*names))).withColumn("pick", F.lit(k))
                            for k, names in picks.items()])


def q_wide_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = wide_feed(spark, sf_dir)
    return schema_check(feed, wide_columns(feed))


def q_wide_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(wide_feed(spark, sf_dir))


def q_wide_numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_profile(wide_feed(spark, sf_dir))


def q_wide_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + G4 + G5 with a source without rows and one that cannot be read."""
    feed = wide_feed(spark, sf_dir)
    sources = [f"w{k}" for k in range(7)] + [EMPTY_SOURCE]
    return validate_feeds(feed, sources, UNREADABLE)


def q_wide_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 + G3 on all columns: odd texts cleaned, leftovers dropped."""
    return enrich(clean(wide_feed(spark, sf_dir)), RUN_TS)


def q_ordered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the distinct values of each categorical column in order, with their rank."""
    values = category_profile(listing_feed(spark, sf_dir)).drop("n_rows")
    return rank_within(values, ["source_name", "column_name"], ["value"])


def q_ordered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 with many values: the distinct ids of each source in order, with their rank."""
    ids = listing_feed(spark, sf_dir).select("source_name", "property_id").distinct()
    return rank_within(ids, ["source_name"], ["property_id"])


def q_wide_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on all ten categorical columns."""
    return category_profile(wide_feed(spark, sf_dir))


def _by_days(spark: SparkSession, sf_dir: str) -> MergedProfile:
    """A profile merged from three days' partial results."""
    feed = stored_copy(wide_feed(spark, sf_dir), "raw-feed", "zstd")  # raw days are stored, too
    store = ProfileStore(spark, scratch_path(spark, "daily-profile"), [c for c in feed.columns if c != "source_name"])
    day = F.pmod(F.xxhash64("property_id", "price"), F.lit(3))
    for k in range(3):
        store.add(f"d{k}", feed.where(day == k), once=False)
    return store.profile(["d0", "d1", "d2"], wide_columns(feed), UNREADABLE)


def q_merged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 by days: scores from stored partial results, equal to those of all rows at once."""
    return _by_days(spark, sf_dir).scores


def q_merged_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 by days."""
    return _by_days(spark, sf_dir).categories


def _monthly(feed: DataFrame) -> DataFrame:
    """The feed as a monthly one: ``feed_date`` is the first day of its month."""
    dated = normalise_date_columns(feed, ["feed_date"])
    return dated.withColumn("feed_date", F.concat(F.substring("feed_date", 1, 7), F.lit("-01")))


def q_counts_by_date_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source, one column per feed date (of the monthly feed)."""
    processed = process(_monthly(listing_feed(spark, sf_dir)), ingestion_timestamp=RUN_TS)
    return pivot_counts(stored_copy(feed_counts(processed), "feed-counts"), "feed_date")


def q_source_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: one folder per source, partitioned by feed date, read back whole."""
    processed = process(_monthly(listing_feed(spark, sf_dir)), ingestion_timestamp=RUN_TS)
    path, root = scratch_path(spark, "by-source"), scratch_path(spark, "folders")
    write_sources(processed, path, overwrite="static")
    stored = read_feed_table(spark, path, processed.schema, ("source_name", "feed_date"))
    names = sorted(r[0] for r in stored.select("source_name").distinct().toLocalIterator())
    paths = write_source_folders(stored, root, names, overwrite="static")
    return combine_sources([read_feed_table(spark, p, processed.drop("source_name").schema, ("feed_date",))
                            .withColumn("source_name", F.lit(n)) for n, p in zip(names, paths, strict=True)])


def q_etl_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9 run twice on the monthly feed. The first run sees no row before 1997, and no null id
    in src1; the second sees all. Survivors move to older dates and src1 fails, so the combined
    table must equal one full run."""
    feed = stored_copy(_monthly(listing_feed(spark, sf_dir)), "monthly-feed")  # a raw feed is stored, too
    out = scratch_path(spark, "etl")
    early = F.coalesce(F.col("feed_date") < "1997-01-01", F.lit(False))
    failing = (F.col("source_name") == "src1") & F.col("property_id").isNull()
    run_etl(feed.where(~early & ~failing), out, ingestion_timestamp=RUN_TS)
    result = run_etl(feed, out, ingestion_timestamp=RUN_TS)
    schema = process(feed, result.validation, RUN_TS).schema
    return read_feed_table(spark, os.path.join(out, "combined"), schema)


def q_etl_nothing_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source has null ids; nothing is written or combined, and the summary says so."""
    feed = listing_feed(spark, sf_dir).withColumn(
        "property_id", F.when(F.col("property_id").endswith("-1"), F.lit("")).otherwise(F.col("property_id")))
    result = run_etl(feed, scratch_path(spark, "etl-none"), ingestion_timestamp=RUN_TS)
    assert result.combined_path is None and combine_sources([]) is None
    return pipeline_summary(result.validation)


WIDE_QUERIES: dict[str, Query] = {
    "wide_quality_score": q_wide_quality_score,
    "wide_overall": q_wide_overall,
    "wide_schema_check": q_wide_schema_check,
    "wide_null_profile": q_wide_null_profile,
    "wide_numeric_profile": q_wide_numeric_profile,
    "wide_validate": q_wide_validate,
    "wide_enrich": q_wide_enrich,
    "ordered_values": q_ordered_values,
    "ordered_ids": q_ordered_ids,
    "wide_categories": q_wide_categories,
    "merged_scores": q_merged_scores,
    "merged_categories": q_merged_categories,
    "counts_by_date_pivot": q_counts_by_date_pivot,
    "source_folders": q_source_folders,
    "etl_after_failure": q_etl_after_failure,
    "etl_nothing_passes": q_etl_nothing_passes,
}

# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

W = f"w AS ({wide_feed_sql()})"
_SCORES = f"""WITH {W},
base AS (
  SELECT source_name, count(*) AS rows, count(*) FILTER (WHERE property_id IS NULL OR property_id = '') AS null_ids,
    count(*) - count(DISTINCT coalesce(property_id, chr(1))) AS duplicate_ids,
    CASE WHEN source_name IN ('w4', 'w5') THEN 2 ELSE 0 END AS missing_columns,
    count(*) FILTER (WHERE try_cast(price AS DOUBLE) < 0) AS negative_prices,
    count(*) FILTER (WHERE try_cast(sqft AS DOUBLE) < 0) AS negative_sqft
  FROM w GROUP BY source_name),
points AS (
  SELECT *, CASE WHEN null_ids > 0 THEN 30 ELSE 0 END AS a, CASE WHEN duplicate_ids > 0 THEN 20 ELSE 0 END AS b,
    CASE WHEN missing_columns > 0 THEN 20 ELSE 0 END AS c, CASE WHEN negative_prices > 0 THEN 5 ELSE 0 END AS d,
    CASE WHEN negative_sqft > 0 THEN 5 ELSE 0 END AS e
  FROM base),
scored AS (
  SELECT source_name, CAST(rows AS BIGINT) AS rows, CAST(null_ids AS BIGINT) AS null_ids,
    CAST(duplicate_ids AS BIGINT) AS duplicate_ids, CAST(missing_columns AS INTEGER) AS missing_columns,
    CAST(negative_prices AS BIGINT) AS negative_prices, CAST(negative_sqft AS BIGINT) AS negative_sqft,
    CAST(100 - a - b - c - d - e AS INTEGER) AS score,
    concat_ws('; ', CASE WHEN a > 0 THEN 'Null property IDs (-30)' END, CASE WHEN b > 0 THEN 'Duplicate IDs (-20)' END,
      CASE WHEN c > 0 THEN 'Missing columns (-20)' END, CASE WHEN d > 0 THEN 'Negative price (-5)' END,
      CASE WHEN e > 0 THEN 'Negative sqft (-5)' END) AS issues, 'PROFILED' AS status
  FROM points
  UNION ALL SELECT 'w9', 0, NULL, NULL, NULL, NULL, NULL, 0, '', 'FAILED: Path does not exist: w9/raw-data')"""
_GRADE = ("CASE WHEN {0} >= 90 THEN 'EXCELLENT' WHEN {0} >= 75 THEN 'GOOD' WHEN {0} >= 60 THEN 'FAIR' "
          "ELSE 'POOR' END")


def _mean_one_decimal(total: str, n: str) -> str:
    """total / n to one decimal, ties to even, on whole numbers."""
    tenths, twice = f"({total} * 10 // {n})", f"(2 * ({total} * 10 % {n}))"
    up = f"CASE WHEN {twice} > {n} OR ({twice} = {n} AND {tenths} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(({tenths} + {up}) / 10.0)"


_WIDE_COLUMNS = (
    "property_id source_agency feed_date sold_let_date transaction_type listing_status address area borough postcode "
    "property_type tenure bedrooms bathrooms sqft price price_per_sqft condition epc_rating heating_type garden parking "
    "floor_level days_on_market agent_id is_chain_free longitude latitude unit_no").split()
_WIDE_NUMBERS = "bedrooms bathrooms sqft price price_per_sqft days_on_market longitude latitude".split()
_INT = (r"CASE WHEN regexp_full_match({0}, '\s*[+-]?(\d+\.?\d*|\.\d+)\s*') "
        "THEN try_cast(trunc(try_cast({0} AS DOUBLE)) AS INTEGER) END")


def _q(name: str) -> str:
    return f'"{name}"'


def _wide_nulls() -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT source_name, '{c}' AS column_name, count(*) AS n, count(*) FILTER (WHERE {_q(c)} IS NULL OR {_q(c)} = '') "
        f"AS empty_count FROM w GROUP BY source_name" for c in _WIDE_COLUMNS)
    pct = _mean_one_decimal("(empty_count * 100)", "n")
    return f"""WITH {W} SELECT source_name, column_name, CAST(empty_count AS BIGINT) AS empty_count,
  CAST({pct} AS DOUBLE) AS pct, CASE WHEN {pct} > 10 THEN '⚠' ELSE 'ℹ' END AS flag
FROM ({parts}) t WHERE empty_count > 0"""


_WIDE_CATEGORIES = ("transaction_type listing_status property_type tenure condition epc_rating heating_type garden parking "
                    "is_chain_free").split()


def _wide_categories(where: str = "true") -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT source_name, '{c}' AS column_name, {_q(c)} AS value FROM w" for c in _WIDE_CATEGORIES)
    return f"""WITH {W} SELECT source_name, column_name, value, count(*) AS n_rows
FROM ({parts}) t WHERE value <> '' AND {where} GROUP BY source_name, column_name, value"""


def _merged_categories() -> str:
    """Sources w4 and w5 have no garden and parking by their headers."""
    return _wide_categories("NOT (source_name IN ('w4', 'w5') AND column_name IN ('garden', 'parking'))")


def _wide_numbers() -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT source_name, '{c}' AS column_name, try_cast({c} AS DOUBLE) AS x FROM w" for c in _WIDE_NUMBERS)
    return f"""WITH {W} SELECT source_name, column_name, count(*) FILTER (WHERE x IS NULL) AS non_numeric,
  count(*) FILTER (WHERE x < 0) AS negatives, count(*) FILTER (WHERE x = 0) AS zeros,
  min(x) AS min_value, max(x) AS max_value,
  CASE WHEN isnan(avg(x)) THEN avg(x) ELSE round(CAST(avg(x) FILTER (WHERE NOT isnan(x)) AS DECIMAL(38,12)), 2)::DOUBLE END AS avg_value,
  count(*) FILTER (WHERE x < 0) > 0 AS has_negatives, count(*) FILTER (WHERE x = 0) > 0 AS has_zeros,
  count(*) FILTER (WHERE x IS NULL) > 0 AS has_non_numeric
FROM ({parts}) t GROUP BY source_name, column_name"""


def _initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda v: upper(v[1:1]) || lower(v[2:])), ' ')"


_SQFT = ("CASE WHEN isnan(try_cast(sqft AS DOUBLE)) OR try_cast(sqft AS DOUBLE) >= 99998 THEN NULL "
         "ELSE abs(try_cast(sqft AS DOUBLE)) END")
_PLAIN = [c for c in _WIDE_COLUMNS if c not in (
    "feed_date", "sold_let_date", "transaction_type", "listing_status", "property_type", "condition", "bedrooms",
    "bathrooms", "sqft", "price", "price_per_sqft")]
_MONTHLY = f"""raw AS ({FEED_CTE[len('feed AS ('):-1]}),
feed AS (SELECT * REPLACE (substr({_norm_date('feed_date')}, 1, 7) || '-01' AS feed_date) FROM raw)"""
_MONTHLY_ROWS = f"{PROCESSED_CTES.replace(FEED_CTE, _MONTHLY)}\nSELECT * FROM processed"
_MONTHS = [f"{y}-{m:02d}-01" for y in range(1995, 2002) for m in range(1, 13) if (y, m) < (2001, 12)]

WIDE_ORACLE_SQL: dict[str, str] = {
    "wide_quality_score": f"""{_SCORES}
SELECT source_name, rows, null_ids, duplicate_ids, missing_columns, negative_prices, negative_sqft, score,
  CASE WHEN source_name = 'w9' THEN 'ERROR' ELSE {_GRADE.format('score')} END AS grade,
  CASE WHEN source_name = 'w9' THEN '✗' WHEN score >= 75 THEN '✓' WHEN score >= 60 THEN '⚠' ELSE '✗' END AS icon,
  issues, status FROM scored""",
    "wide_overall": f"""{_SCORES},
picks(pick, source_name) AS (VALUES ('safe', 'w0'), ('safe', 'w1'), ('safe', 'w4'), ('review', 'w1'), ('review', 'w2'),
  ('review', 'w3'), ('stop', 'w2'), ('stop', 'w3'), ('stop', 'w9')),
sums AS (SELECT pick, sum(rows) AS total_rows, count(*) AS sources, CAST({_mean_one_decimal('sum(score)::BIGINT', 'count(*)')} AS DOUBLE) AS avg_score
  FROM picks JOIN scored USING (source_name) GROUP BY pick)
SELECT CAST(total_rows AS BIGINT) AS total_rows, sources, avg_score, {_GRADE.format('avg_score')} AS grade,
  CASE WHEN avg_score >= 75 THEN 'SAFE_TO_RUN_ETL' WHEN avg_score >= 60 THEN 'REVIEW_BEFORE_ETL'
       ELSE 'DO_NOT_RUN_ETL' END AS advice, pick FROM sums""",
    "wide_schema_check": """SELECT * FROM (VALUES ('w0', 'unit_no', 'extra'), ('w1', 'unit_no', 'extra'),
  ('w2', 'unit_no', 'extra'), ('w3', 'unit_no', 'extra'), ('w4', 'unit_no', 'extra'), ('w5', 'unit_no', 'extra'),
  ('w6', 'unit_no', 'extra'), ('w4', 'garden', 'missing'), ('w4', 'parking', 'missing'), ('w5', 'garden', 'missing'),
  ('w5', 'parking', 'missing')) v(source_name, column_name, issue)""",
    "wide_null_profile": _wide_nulls(),
    "wide_numeric_profile": _wide_numbers(),
    "wide_validate": f"""WITH {W},
base AS (SELECT source_name, count(*) AS total_rows,
    count(*) FILTER (WHERE property_id IS NULL OR property_id = '') AS null_ids,
    count(*) - count(DISTINCT coalesce(property_id, chr(1))) AS duplicate_ids,
    count(*) FILTER (WHERE {_INT.format('price')} < 0) AS negative_prices,
    count(*) FILTER (WHERE {_INT.format('sqft')} < 0) AS negative_sqft FROM w GROUP BY source_name)
SELECT *, null_ids = 0 AS passed, CASE WHEN null_ids > 0 THEN 'VALIDATION FAILED [' || source_name || ']: ' || null_ids
  || ' null property IDs!' END AS message FROM base
UNION ALL SELECT 'w8', 0, 0, 0, 0, 0, false, 'VALIDATION FAILED [w8]: No records found!'
UNION ALL SELECT 'w9', 0, 0, 0, 0, 0, false, 'Path does not exist: w9/raw-data'""",
    "wide_enrich": f"""WITH {W}, c AS (SELECT *, {_SQFT} AS area_, abs(try_cast(price AS DOUBLE)) AS price_ FROM w)
SELECT {', '.join(_q(c) for c in _PLAIN)}, source_name,
  {_norm_date('feed_date')} AS feed_date, {_norm_date('sold_let_date')} AS sold_let_date,
  {_initcap('transaction_type')} AS transaction_type, {_initcap('listing_status')} AS listing_status,
  {_initcap('property_type')} AS property_type, {_initcap(_q('condition'))} AS "condition",
  CASE WHEN {_INT.format('bedrooms')} >= 0 THEN {_INT.format('bedrooms')} END AS bedrooms,
  CASE WHEN {_INT.format('bathrooms')} >= 0 THEN {_INT.format('bathrooms')} END AS bathrooms,
  area_ AS sqft, price_ AS price,
  CASE WHEN area_ > 0 THEN round(CAST(price_ / area_ AS DECIMAL(38,12)), 2)::DOUBLE END AS price_per_sqft,
  '{RUN_TS}' AS ingestion_timestamp FROM c""",
    "ordered_values": f"""WITH {FEED_CTE}
SELECT source_name, column_name, value,
  row_number() OVER (PARTITION BY source_name, column_name ORDER BY value) AS rank
FROM (SELECT DISTINCT source_name, column_name, value FROM feed UNPIVOT (value FOR column_name IN
  (transaction_type, listing_status, property_type, tenure)) WHERE value <> '')""",
    "ordered_ids": f"""WITH {FEED_CTE}
SELECT source_name, property_id, row_number() OVER (PARTITION BY source_name ORDER BY property_id NULLS FIRST) AS rank
FROM (SELECT DISTINCT source_name, property_id FROM feed)""",
    "wide_categories": _wide_categories(),
    "merged_categories": _merged_categories(),
    "merged_scores": f"""{_SCORES}
SELECT source_name, rows, null_ids, duplicate_ids, missing_columns, negative_prices, negative_sqft, score,
  CASE WHEN source_name = 'w9' THEN 'ERROR' ELSE {_GRADE.format('score')} END AS grade,
  CASE WHEN source_name = 'w9' THEN '✗' WHEN score >= 75 THEN '✓' WHEN score >= 60 THEN '⚠' ELSE '✗' END AS icon,
  issues, status FROM scored""",
    "counts_by_date_pivot": f"""{PROCESSED_CTES.replace(FEED_CTE, _MONTHLY)}
SELECT source_name, {', '.join(f"count(*) FILTER (WHERE feed_date = '{m}') AS {_q(m)}" for m in _MONTHS)},
  count(*) FILTER (WHERE feed_date IS NULL) AS "null" FROM processed GROUP BY source_name""",
    "source_folders": _MONTHLY_ROWS,
    "etl_after_failure": _MONTHLY_ROWS,
    "etl_nothing_passes": f"""WITH {FEED_CTE}
SELECT source_name, CAST(0 AS BIGINT) AS rows, 'FAILED: VALIDATION FAILED [' || source_name || ']: '
  || count(*) FILTER (WHERE property_id IS NULL OR property_id LIKE '%-1') || ' null property IDs!' AS status
FROM feed GROUP BY source_name""",
}
