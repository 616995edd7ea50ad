"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads ``lineitem`` through the ``listing_feed`` fixture (one feed
row per line item, ten sources), so its work grows with the table. The
oracle texts are written independently in DuckDB's dialect (``try_strptime``
for dates, list functions for word case, DECIMAL rounding for Spark's
half-up ``round``) and name and type every column like the Spark side.

At sf0.01 the fixture has null ids in src0-src2, so validation fails those
three and passes src3-src9; queries downstream of the gate see seven sources.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.operators import (
    category_profile,
    clean,
    combine_sources,
    date_format_profile,
    dedupe,
    duplicate_keys,
    enrich,
    feed_counts,
    feed_totals,
    null_profile,
    numeric_profile,
    pipeline_summary,
    pivot_counts,
    quality_overall,
    quality_scores,
    schema_check,
    source_stats,
    validate_feeds,
)
from feedlake.functions.dates import date_format_label, normalise_date_columns
from feedlake.plans.pipeline import checkpointed, process, profile
from feedlake.session import scratch_path, stored_copy
from feedlake.sinks import read_feed_table, register_table, write_combined
from feedlake.sources.csv_feeds import read_feed_scan
from feedlake.sources.fixture import listing_feed, listing_feed_sql
from feedlake.streaming.store import FeedStore

# Fixed ingestion time of the registered runs, so results are reproducible.
RUN_TS = "2025-01-07 06:00:00"

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_feed(spark, sf_dir)


def q_feed_counts_by_source_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on the processed feed: rows per passing source and clean feed_date."""
    return feed_counts(process(_feed(spark, sf_dir), ingestion_timestamp=RUN_TS))


def q_feed_counts_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows per source, one column per feed year."""
    processed = process(_feed(spark, sf_dir), ingestion_timestamp=RUN_TS)
    by_year = processed.withColumn("year", F.substring("feed_date", 1, 4))
    counts = checkpointed(feed_counts(by_year, by="year"))
    return pivot_counts(counts, "year")


def q_normalise_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 on both date columns of every feed row."""
    feed = _feed(spark, sf_dir)
    both = feed.select(
        C.KEY_COL, C.SOURCE_COL,
        F.col("feed_date").alias("feed_date_raw"), "feed_date",
        F.col("sold_let_date").alias("sold_let_date_raw"), "sold_let_date")
    return normalise_date_columns(both, ["feed_date", "sold_let_date"])


def q_date_format_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_format_profile(_feed(spark, sf_dir))


def q_clean_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_feed(spark, sf_dir))


def q_enrich_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(clean(_feed(spark, sf_dir)), RUN_TS)


def q_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(clean(_feed(spark, sf_dir)), order_by="all")


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(_feed(spark, sf_dir), k=5)


def q_validate_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_feeds(_feed(spark, sf_dir))


def q_numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_profile(_feed(spark, sf_dir))


def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(_feed(spark, sf_dir))


def q_category_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_profile(_feed(spark, sf_dir))


def q_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_feed(spark, sf_dir))


def q_quality_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_overall(quality_scores(_feed(spark, sf_dir)))


def q_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_check(_feed(spark, sf_dir))


def q_source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_stats(_feed(spark, sf_dir))


def q_combine_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows of the passing sources, where the odd-numbered
    sources arrive without a ``tenure`` column (filled with null)."""
    feed = _feed(spark, sf_dir)
    validation = stored_copy(validate_feeds(feed), "validation")
    odd = F.substring(C.SOURCE_COL, 4, 10).cast("int") % 2 == 1
    with_tenure = process(feed.where(~odd), validation, RUN_TS)
    without_tenure = process(feed.where(odd), validation, RUN_TS).drop("tenure")
    return combine_sources([with_tenure, without_tenure])


def _table_name(kind: str) -> str:
    return f"feedlake_{kind}_{uuid.uuid4().hex[:10]}"


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + K3 + S3: write the processed feed partitioned by feed_date and
    source, register it as a table, and read the whole table back."""
    processed = process(_feed(spark, sf_dir), ingestion_timestamp=RUN_TS)
    path = scratch_path(spark, "combined")
    write_combined(processed, path, overwrite="static")
    name = register_table(spark, _table_name("roundtrip"), path, processed.schema)
    return spark.table(name)


def q_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 as published: SQL over the registered combined table."""
    processed = process(_feed(spark, sf_dir), ingestion_timestamp=RUN_TS)
    path = scratch_path(spark, "combined-q1")
    write_combined(processed, path, overwrite="static")
    name = register_table(spark, _table_name("q1"), path, processed.schema)
    return spark.sql(f"SELECT source_name, feed_date, COUNT(*) AS rows FROM {name} "
                     "GROUP BY source_name, feed_date ORDER BY source_name, feed_date")


def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all rows but those of 1998, then those of 1998 as a batch of their own, and read
    the whole table: it must equal one full load. Rows of 1998 take over ids of older ones."""
    feed = stored_copy(_feed(spark, sf_dir), "raw-feed")  # a raw feed is stored, too
    store = FeedStore(spark, scratch_path(spark, "incremental"), [c for c in feed.columns if c != C.SOURCE_COL])
    late = F.coalesce(F.col("feed_date").contains("1998"), F.lit(False))
    store.apply(feed.where(~late), ingestion_timestamp=RUN_TS)
    store.apply(feed.where(late), ingestion_timestamp=RUN_TS)
    return store.read()


def q_date_format_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with full labels: rows per source and ``feed_date`` label."""
    feed = _feed(spark, sf_dir)
    return (feed.groupBy(C.SOURCE_COL, date_format_label("feed_date").alias("label"))
                .agg(F.count(F.lit(1)).alias("rows")))


def q_csv_feed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: write the fixture as one CSV folder per source, read the
    folders back in one scan, by the files' headers, and score them."""
    feed = _feed(spark, sf_dir)
    root = scratch_path(spark, "csv-feeds")
    (feed.write.mode("overwrite").partitionBy(C.SOURCE_COL).option("header", "true").csv(root))
    names = [r[0] for r in feed.select(C.SOURCE_COL).distinct().toLocalIterator()]
    feeds = read_feed_scan(spark, root, names, layout=f"{C.SOURCE_COL}={{source}}/",
                           pattern=f"/{C.SOURCE_COL}=([^/]+)/[^/]*$")
    return quality_scores(feeds.df, feeds.columns, feeds.errors)


def q_profile_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile bundle (metrics checkpointed once, reports reshaped)."""
    return profile(_feed(spark, sf_dir)).scores


def q_profile_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date formats from the bundle's shared per-value aggregation."""
    return profile(_feed(spark, sf_dir)).dates


def q_profile_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categorical values from the bundle's shared per-value aggregation."""
    return profile(_feed(spark, sf_dir)).categories


def q_date_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: the first three date texts per source and date column."""
    return profile(_feed(spark, sf_dir)).date_samples


def q_combined_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total rows and (source, feed_date) partitions of the combined data."""
    return feed_totals(process(_feed(spark, sf_dir), ingestion_timestamp=RUN_TS))


def q_pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline_summary(validate_feeds(_feed(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "feed_counts_by_source_date": q_feed_counts_by_source_date,
    "feed_counts_pivot": q_feed_counts_pivot,
    "normalise_dates": q_normalise_dates,
    "date_format_profile": q_date_format_profile,
    "clean_listings": q_clean_listings,
    "enrich_listings": q_enrich_listings,
    "dedupe_first": q_dedupe_first,
    "duplicate_keys": q_duplicate_keys,
    "validate_feeds": q_validate_feeds,
    "numeric_profile": q_numeric_profile,
    "null_profile": q_null_profile,
    "category_profile": q_category_profile,
    "quality_score": q_quality_score,
    "quality_overall": q_quality_overall,
    "schema_check": q_schema_check,
    "source_stats": q_source_stats,
    "combine_sources": q_combine_sources,
    "parquet_roundtrip": q_parquet_roundtrip,
    "table_counts": q_table_counts,
    "incremental_load": q_incremental_load,
    "pipeline_summary": q_pipeline_summary,
    "date_format_labels": q_date_format_labels,
    "csv_feed_scores": q_csv_feed_scores,
    "profile_scores": q_profile_scores,
    "profile_date_formats": q_profile_date_formats,
    "profile_categories": q_profile_categories,
    "combined_totals": q_combined_totals,
    "date_samples": q_date_samples,
}


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

def _strip(x: str) -> str:
    return f"trim({x})"


def _norm_date(x: str) -> str:
    t = _strip(x)
    fmts = ["%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d %b %Y", "%d-%m-%Y"]
    parsed = ", ".join(f"try_strptime({t}, '{f}')" for f in fmts)
    return (f"CASE WHEN {x} IS NULL OR {t} IN ('', 'None') THEN NULL "
            f"WHEN length({t}) = 10 AND substr({t}, 5, 1) = '-' THEN {t} "
            f"ELSE strftime(coalesce({parsed}), '%Y-%m-%d') END")


def _date_bucket(x: str) -> str:
    t = _strip(x)
    labels = [("%Y-%m-%d", "YYYY-MM-DD"), ("%d/%m/%Y", "DD/MM/YYYY"),
              ("%Y/%m/%d", "YYYY/MM/DD"), ("%d %b %Y", "DD Mon YYYY")]
    whens = " ".join(f"WHEN try_strptime({t}, '{f}') IS NOT NULL THEN '{lab}'" for f, lab in labels)
    return f"CASE WHEN {x} IS NULL OR {t} = '' THEN 'empty' {whens} ELSE 'UNKNOWN' END"


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def _round(x: str, n: int) -> str:
    return f"round(CAST({x} AS DECIMAL(38,12)), {n})::DOUBLE"


def _py_round(x: str, n: int) -> str:
    """Python's round(x, n) for 0 <= x < 128, by exact 64-bit arithmetic."""
    scale = 10 ** n
    tiny = 2.0 ** -10
    k0 = f"(52 - CAST(floor(log2({x})) AS INTEGER))"
    x0 = f"({x} * power(2.0, {k0}))"
    sh = f"(CASE WHEN {x0} >= {float(2 ** 53)} THEN {k0} - 1 WHEN {x0} < {float(2 ** 52)} THEN {k0} + 1 ELSE {k0} END)"
    mant = f"CAST({x} * power(2.0, {sh}) AS BIGINT)"
    k = f"(({mant} * {scale}) >> {sh})"
    cmp = f"({mant} * {2 * scale} - ({k} * 2 + 1) * (CAST(1 AS BIGINT) << {sh}))"
    up = f"(CASE WHEN {cmp} > 0 THEN true WHEN {cmp} < 0 THEN false ELSE {k} % 2 = 1 END)"
    exact = f"(CAST(CASE WHEN {up} THEN {k} + 1 ELSE {k} END AS DOUBLE) / {scale})"
    return (f"(CASE WHEN {x} >= {tiny} AND {x} < 128 THEN {exact} "
            f"WHEN {x} >= 0 AND {x} < {tiny} THEN 0.0 ELSE round_even({x}, {n}) END)")


def _int_parse(x: str) -> str:
    return f"try_cast({x} AS INTEGER)"


def _null_or_empty(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


FEED_CTE = f"feed AS ({listing_feed_sql('lineitem')})"

PASSING_CTE = """passing AS (
  SELECT source_name FROM feed GROUP BY source_name
  HAVING count(*) > 0
     AND count(*) FILTER (WHERE property_id IS NULL OR property_id = '') = 0)"""

CLEAN_SELECT = f"""SELECT property_id, source_name,
  {_norm_date('feed_date')} AS feed_date,
  {_norm_date('sold_let_date')} AS sold_let_date,
  transaction_type, listing_status, property_type, tenure,
  CASE WHEN {_int_parse('bedrooms')} >= 0 THEN {_int_parse('bedrooms')} END AS bedrooms,
  CASE WHEN {_int_parse('bathrooms')} >= 0 THEN {_int_parse('bathrooms')} END AS bathrooms,
  CASE WHEN try_cast(sqft AS DOUBLE) >= 99998 THEN NULL
       ELSE abs(try_cast(sqft AS DOUBLE)) END AS sqft,
  abs(try_cast(price AS DOUBLE)) AS price"""

_ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in (
    "feed_date", "sold_let_date", "transaction_type", "listing_status", "property_type",
    "tenure", "bedrooms", "bathrooms", "sqft", "price"))

DEDUP_SELECT = ("SELECT * FROM cleaned QUALIFY row_number() OVER "
                f"(PARTITION BY source_name, property_id ORDER BY {_ORDER_ALL}) = 1")

ENRICH_SELECT = f"""SELECT property_id, source_name, feed_date, sold_let_date,
  {_initcap('transaction_type')} AS transaction_type,
  {_initcap('listing_status')} AS listing_status,
  {_initcap('property_type')} AS property_type,
  tenure, bedrooms, bathrooms, sqft, price,
  '{RUN_TS}' AS ingestion_timestamp,
  CASE WHEN sqft IS NOT NULL AND sqft > 0 THEN {_round('price / sqft', 2)} END AS price_per_sqft"""

# feed -> passing sources -> clean -> dedupe -> enrich, as CTEs.
PROCESSED_CTES = f"""WITH {FEED_CTE},
{PASSING_CTE},
cleaned AS ({CLEAN_SELECT} FROM feed WHERE source_name IN (SELECT source_name FROM passing)),
deduped AS ({DEDUP_SELECT}),
processed AS ({ENRICH_SELECT} FROM deduped)"""

_NUMERIC_PRESENT = ("bedrooms", "bathrooms", "sqft", "price")
_FEED_DATA_COLUMNS = ("property_id", "feed_date", "sold_let_date", "transaction_type",
                      "listing_status", "property_type", "tenure", "bedrooms", "bathrooms",
                      "sqft", "price")
_MISSING = ("source_agency", "address", "area", "borough", "postcode", "price_per_sqft", "condition", "epc_rating",
            "heating_type", "garden", "parking", "floor_level", "days_on_market", "agent_id", "is_chain_free",
            "longitude", "latitude")


def _numeric_profile_sql() -> str:
    parts = []
    for c in _NUMERIC_PRESENT:
        d = f"try_cast({c} AS DOUBLE)"
        parts.append(f"""SELECT source_name, '{c}' AS column_name,
  count(*) FILTER (WHERE {d} IS NULL) AS non_numeric,
  count(*) FILTER (WHERE {d} < 0) AS negatives,
  count(*) FILTER (WHERE {d} = 0) AS zeros,
  min({d}) AS min_value, max({d}) AS max_value,
  {_round(f'avg({d})', 2)} AS avg_value
FROM feed GROUP BY source_name""")
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH {FEED_CTE}
SELECT source_name, column_name, non_numeric, negatives, zeros, min_value, max_value, avg_value,
  negatives > 0 AS has_negatives, zeros > 0 AS has_zeros, non_numeric > 0 AS has_non_numeric
FROM ({body}) t"""


def _null_profile_sql() -> str:
    parts = [f"""SELECT source_name, '{c}' AS column_name, count(*) AS total,
  count(*) FILTER (WHERE {_null_or_empty(c)}) AS empty_count FROM feed GROUP BY source_name"""
             for c in _FEED_DATA_COLUMNS]
    body = "\nUNION ALL\n".join(parts)
    pct = _py_round("(empty_count / total * 100)", 1)
    return f"""WITH {FEED_CTE}
SELECT source_name, column_name, empty_count, {pct} AS pct,
  CASE WHEN {pct} > 10 THEN '⚠' ELSE 'ℹ' END AS flag
FROM ({body}) t WHERE empty_count > 0"""


def _category_profile_sql() -> str:
    cats = ["transaction_type", "listing_status", "property_type", "tenure"]
    body = "\nUNION ALL\n".join(
        f"SELECT source_name, '{c}' AS column_name, {c} AS value FROM feed" for c in cats)
    return f"""WITH {FEED_CTE}
SELECT source_name, column_name, value, count(*) AS n_rows
FROM ({body}) t WHERE value IS NOT NULL AND value <> ''
GROUP BY source_name, column_name, value"""


def _date_format_profile_sql() -> str:
    body = "\nUNION ALL\n".join(
        f"SELECT source_name, '{c}' AS column_name, {c} AS value FROM feed"
        for c in ("feed_date", "sold_let_date"))
    return f"""WITH {FEED_CTE}
SELECT source_name, column_name, {_date_bucket('value')} AS date_format,
  count(*) AS n_rows, min(trim(value)) AS sample_value
FROM ({body}) t GROUP BY ALL"""


_SCORE_BASE = f"""WITH {FEED_CTE},
base AS (
  SELECT source_name, count(*) AS rows,
    count(*) FILTER (WHERE {_null_or_empty('property_id')}) AS null_ids,
    count(*) - count(DISTINCT property_id) - max(CASE WHEN property_id IS NULL THEN 1 ELSE 0 END) AS duplicate_ids,
    {len(_MISSING)} AS missing_columns,
    count(*) FILTER (WHERE try_cast(price AS DOUBLE) < 0) AS negative_prices,
    count(*) FILTER (WHERE try_cast(sqft AS DOUBLE) < 0) AS negative_sqft
  FROM feed GROUP BY source_name),
scored AS (
  SELECT *, greatest(0, 100
      - CASE WHEN null_ids > 0 THEN 30 ELSE 0 END
      - CASE WHEN duplicate_ids > 0 THEN 20 ELSE 0 END
      - CASE WHEN missing_columns > 0 THEN 20 ELSE 0 END
      - CASE WHEN negative_prices > 0 THEN 5 ELSE 0 END
      - CASE WHEN negative_sqft > 0 THEN 5 ELSE 0 END) AS score,
    concat_ws('; ',
      CASE WHEN null_ids > 0 THEN 'Null property IDs (-30)' END,
      CASE WHEN duplicate_ids > 0 THEN 'Duplicate IDs (-20)' END,
      CASE WHEN missing_columns > 0 THEN 'Missing columns (-20)' END,
      CASE WHEN negative_prices > 0 THEN 'Negative price (-5)' END,
      CASE WHEN negative_sqft > 0 THEN 'Negative sqft (-5)' END) AS issues
  FROM base)"""

_GRADE = ("CASE WHEN {s} >= 90 THEN 'EXCELLENT' WHEN {s} >= 75 THEN 'GOOD' "
          "WHEN {s} >= 60 THEN 'FAIR' ELSE 'POOR' END")


def _quality_score_sql() -> str:
    g = _GRADE.format(s="score")
    return f"""{_SCORE_BASE}
SELECT source_name, CAST(rows AS BIGINT) AS rows, CAST(null_ids AS BIGINT) AS null_ids,
  CAST(duplicate_ids AS BIGINT) AS duplicate_ids, CAST(missing_columns AS INTEGER) AS missing_columns,
  CAST(negative_prices AS BIGINT) AS negative_prices, CAST(negative_sqft AS BIGINT) AS negative_sqft,
  CAST(score AS INTEGER) AS score, {g} AS grade,
  CASE WHEN {g} IN ('EXCELLENT', 'GOOD') THEN '✓' WHEN {g} = 'FAIR' THEN '⚠'
       ELSE '✗' END AS icon,
  issues, 'PROFILED' AS status
FROM scored"""


def _quality_overall_sql() -> str:
    avg = _py_round("avg(score)", 1)
    return f"""{_SCORE_BASE}
SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS sources,
  {avg} AS avg_score, {_GRADE.format(s=avg)} AS grade,
  CASE WHEN {avg} >= 75 THEN 'SAFE_TO_RUN_ETL'
       WHEN {avg} >= 60 THEN 'REVIEW_BEFORE_ETL'
       ELSE 'DO_NOT_RUN_ETL' END AS advice
FROM scored"""


def _validate_sql() -> str:
    return f"""WITH {FEED_CTE},
base AS (
  SELECT source_name, count(*) AS total_rows,
    count(*) FILTER (WHERE {_null_or_empty('property_id')}) AS null_ids,
    count(*) - count(DISTINCT property_id) - max(CASE WHEN property_id IS NULL THEN 1 ELSE 0 END) AS duplicate_ids,
    count(*) FILTER (WHERE {_int_parse('price')} < 0) AS negative_prices,
    count(*) FILTER (WHERE {_int_parse('sqft')} < 0) AS negative_sqft
  FROM feed GROUP BY source_name)
SELECT source_name, CAST(total_rows AS BIGINT) AS total_rows, CAST(null_ids AS BIGINT) AS null_ids,
  CAST(duplicate_ids AS BIGINT) AS duplicate_ids, CAST(negative_prices AS BIGINT) AS negative_prices,
  CAST(negative_sqft AS BIGINT) AS negative_sqft,
  NOT (total_rows = 0 OR null_ids > 0) AS passed,
  CASE WHEN total_rows = 0 THEN 'VALIDATION FAILED [' || source_name || ']: No records found!'
       WHEN null_ids > 0 THEN 'VALIDATION FAILED [' || source_name || ']: ' || null_ids || ' null property IDs!'
  END AS message
FROM base"""


def _pipeline_summary_sql() -> str:
    return f"""WITH v AS ({_validate_sql()})
SELECT source_name, CAST(CASE WHEN passed THEN total_rows ELSE 0 END AS BIGINT) AS rows,
  CASE WHEN passed THEN 'SUCCESS' ELSE 'FAILED: ' || message END AS status
FROM v"""


def _schema_check_sql() -> str:
    rows = ", ".join(f"('{c}', 'missing')" for c in _MISSING)
    return f"""WITH {FEED_CTE}
SELECT s.source_name, m.column_name, m.issue
FROM (SELECT DISTINCT source_name FROM feed) s,
     (VALUES {rows}) AS m(column_name, issue)"""


def _source_stats_sql() -> str:
    return f"""WITH {FEED_CTE}
SELECT source_name, CAST(count(*) AS BIGINT) AS rows,
  CAST({len(_FEED_DATA_COLUMNS)} AS INTEGER) AS column_count
FROM feed GROUP BY source_name"""


def _feed_counts_sql() -> str:
    return f"""{PROCESSED_CTES}
SELECT source_name, feed_date, CAST(count(*) AS BIGINT) AS rows
FROM processed GROUP BY source_name, feed_date
ORDER BY source_name NULLS FIRST, feed_date NULLS FIRST"""


def _feed_counts_pivot_sql() -> str:
    years = [str(y) for y in range(1995, 2002)]
    cols = ", ".join(
        f"CAST(count(*) FILTER (WHERE substr(feed_date, 1, 4) = '{y}') AS BIGINT) AS \"{y}\""
        for y in years)
    return f"""{PROCESSED_CTES}
SELECT source_name, {cols},
  CAST(count(*) FILTER (WHERE feed_date IS NULL) AS BIGINT) AS "null"
FROM processed GROUP BY source_name ORDER BY source_name"""


def _date_format_labels_sql() -> str:
    label = _date_bucket("feed_date").replace("ELSE 'UNKNOWN' END",
                                              "ELSE 'UNKNOWN (' || trim(feed_date) || ')' END")
    return f"""WITH {FEED_CTE}
SELECT source_name, {label} AS label, CAST(count(*) AS BIGINT) AS rows
FROM feed GROUP BY ALL"""


def _date_samples_sql() -> str:
    body = "\nUNION ALL\n".join(
        f"SELECT source_name, '{c}' AS column_name, {c} AS value FROM feed"
        for c in ("feed_date", "sold_let_date"))
    return f"""WITH {FEED_CTE},
texts AS (
  SELECT source_name, column_name, trim(value) AS sample_value,
    {_date_bucket('value')} AS date_format
  FROM ({body}) t
  WHERE value IS NOT NULL AND trim(value) <> ''
  GROUP BY ALL)
SELECT source_name, column_name, sample_value, date_format,
  CAST(row_number() OVER (PARTITION BY source_name, column_name ORDER BY sample_value) AS INTEGER) AS sample_rank
FROM texts
QUALIFY sample_rank <= 3"""


def _processed_rows_sql() -> str:
    return f"""{PROCESSED_CTES}
SELECT * FROM processed"""


ORACLE_SQL: dict[str, str] = {
    "feed_counts_by_source_date": _feed_counts_sql(),
    "feed_counts_pivot": _feed_counts_pivot_sql(),
    "normalise_dates": f"""WITH {FEED_CTE}
SELECT property_id, source_name, feed_date AS feed_date_raw, {_norm_date('feed_date')} AS feed_date,
  sold_let_date AS sold_let_date_raw, {_norm_date('sold_let_date')} AS sold_let_date
FROM feed""",
    "date_format_profile": _date_format_profile_sql(),
    "clean_listings": f"WITH {FEED_CTE}\n{CLEAN_SELECT} FROM feed",
    "enrich_listings": f"WITH {FEED_CTE}, cleaned AS ({CLEAN_SELECT} FROM feed)\n{ENRICH_SELECT} FROM cleaned",
    "dedupe_first": f"WITH {FEED_CTE}, cleaned AS ({CLEAN_SELECT} FROM feed)\n{DEDUP_SELECT}",
    "duplicate_keys": f"""WITH {FEED_CTE}
SELECT source_name, property_id, CAST(count(*) AS BIGINT) AS occurrences,
  CAST(row_number() OVER (PARTITION BY source_name
       ORDER BY count(*) DESC, property_id ASC NULLS FIRST) AS INTEGER) AS rank
FROM feed GROUP BY source_name, property_id HAVING count(*) > 1
QUALIFY rank <= 5""",
    "validate_feeds": _validate_sql(),
    "numeric_profile": _numeric_profile_sql(),
    "null_profile": _null_profile_sql(),
    "category_profile": _category_profile_sql(),
    "quality_score": _quality_score_sql(),
    "quality_overall": _quality_overall_sql(),
    "schema_check": _schema_check_sql(),
    "source_stats": _source_stats_sql(),
    "combine_sources": f"""{PROCESSED_CTES}
SELECT * REPLACE (CASE WHEN CAST(substr(source_name, 4) AS INTEGER) % 2 = 1 THEN NULL ELSE tenure END AS tenure)
FROM processed""",
    "parquet_roundtrip": _processed_rows_sql(),
    "table_counts": _feed_counts_sql(),
    "incremental_load": _processed_rows_sql(),
    "pipeline_summary": _pipeline_summary_sql(),
    "date_format_labels": _date_format_labels_sql(),
    "csv_feed_scores": _quality_score_sql(),
    "profile_scores": _quality_score_sql(),
    "profile_date_formats": _date_format_profile_sql(),
    "profile_categories": _category_profile_sql(),
    "combined_totals": f"""{PROCESSED_CTES}
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(DISTINCT (source_name, coalesce(feed_date, ''))) AS BIGINT) AS partitions
FROM processed""",
    "date_samples": _date_samples_sql(),
}
