"""``listing_feed``: a raw multi-source listing feed derived from ``lineitem``.

The driver's tables hold no property listings, so the registered queries run
on this derivation. One SQL text serves both engines: Spark runs it with the
``lineitem`` DataFrame bound as a parameter, the DuckDB oracle runs it against
its ``lineitem`` view. Every row of ``lineitem`` becomes one feed row, so the
work grows with the table. All columns are text, like a CSV scan.

Designed anomalies: null ids in three sources, duplicate ids in every source,
five date formats plus junk, blank and null cells, the sqft placeholder,
negative sqft and prices, negative bedrooms and bathrooms, mixed case.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed text: the fixture definition shared with the oracle.
LISTING_FEED_SELECT = """
SELECT
  CASE WHEN k % 499 = 0 AND s < 3 THEN NULL ELSE concat('L', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS property_id,
  concat('src', CAST(s AS STRING)) AS source_name,
  CASE WHEN k % 97 = 0 THEN 'not a date' WHEN k % 101 = 0 THEN NULL
       WHEN s % 5 = 0 THEN concat(yy, '-', mm, '-', dd)
       WHEN s % 5 = 1 THEN concat(dd, '/', mm, '/', yy)
       WHEN s % 5 = 2 THEN concat(yy, '/', mm, '/', dd)
       WHEN s % 5 = 3 THEN concat(dd, ' ', substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(mm AS INT) * 3 - 2, 3), ' ', yy)
       ELSE concat(dd, '-', mm, '-', yy) END AS feed_date,
  CASE WHEN k % 6 = 0 THEN '' WHEN k % 3 = 0 THEN NULL ELSE concat(yy, '-', mm, '-', dd) END AS sold_let_date,
  CASE WHEN k % 2 = 0 THEN 'Sale' ELSE 'Rental' END AS transaction_type,
  CASE k % 4 WHEN 0 THEN 'UNDER OFFER' WHEN 1 THEN 'let agreed' WHEN 2 THEN 'Sold' ELSE 'Active' END AS listing_status,
  CASE k % 3 WHEN 0 THEN 'Semi-Detached' WHEN 1 THEN 'terraced house' ELSE 'Flat' END AS property_type,
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN 'Freehold' ELSE 'Leasehold' END AS tenure,
  CASE WHEN k % 61 = 0 THEN NULL ELSE CAST(k % 7 - 1 AS STRING) END AS bedrooms,
  CAST(l_linenumber - 2 AS STRING) AS bathrooms,
  CASE WHEN k % 71 = 0 THEN NULL WHEN k % 73 = 0 THEN '99999' WHEN k % 79 = 0 THEN '-200' WHEN k % 83 = 0 THEN '0'
       ELSE CAST(CAST(l_quantity AS BIGINT) * 40 + 200 AS STRING) END AS sqft,
  CASE WHEN k % 89 = 0 THEN NULL WHEN k % 53 = 0 THEN concat('-', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING))
       ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END AS price
FROM (SELECT *, l_partkey + l_suppkey * 7 AS k, l_suppkey % 10 AS s,
             CAST(year(l_shipdate) AS STRING) AS yy,
             lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS mm,
             lpad(CAST(day(l_shipdate) AS STRING), 2, '0') AS dd
      FROM {lineitem}) b
"""

# Columns of the fixture, in order.
LISTING_FEED_COLUMNS: tuple[str, ...] = (
    "property_id", "source_name", "feed_date", "sold_let_date",
    "transaction_type", "listing_status", "property_type", "tenure",
    "bedrooms", "bathrooms", "sqft", "price",
)

# The lineitem columns the fixture reads (the scan is pruned to these).
_LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     "l_quantity", "l_extendedprice", "l_shipdate")


def listing_feed_sql(table: str = "lineitem") -> str:
    """The fixture as SQL over a table or view called ``table`` (for DuckDB)."""
    return LISTING_FEED_SELECT.replace("{lineitem}", table)


def listing_feed_from(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    """The fixture over a ``lineitem`` DataFrame."""
    return spark.sql(LISTING_FEED_SELECT, lineitem=lineitem.select(*_LINEITEM_COLUMNS))


def listing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture over ``{sf_dir}/lineitem.parquet``."""
    return listing_feed_from(spark, spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")))
