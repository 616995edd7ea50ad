"""``wide_feed``: all 28 feed columns, one row per line item, from ``lineitem``
joined with ``orders``, ``part``, ``customer`` and ``supplier``.

One SQL text serves Spark and the DuckDB oracle. Sources are built so that
every grade, icon and advice occurs:

====  ==============================================================  =====
w0    clean                                                             100
w1    duplicate ids                                                      80
w2    null ids                                                           70
w3    null ids, duplicate ids                                            50
w4    header lacks two columns, negative prices                          75
w5    header lacks two columns, negative prices, negative sqft           70
w6    negative prices, negative sqft; odd texts (see below)              90
====  ==============================================================  =====

``w8`` is registered but has no rows, ``w9`` cannot be read. Source w6 holds
the texts that readings differ on: decimals in integer columns, NaN, a negative
placeholder, outer blanks, exponents, unvalidated ISO dates. The header also
names an extra column (``unit_no``) and a crawler leftover (``partition_0``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDE_FEED_SELECT = """
SELECT
  CASE WHEN s IN (2, 3) AND k % 211 = 0 THEN NULL
       WHEN s IN (1, 3) AND k % 5 = 0 THEN concat('W', CAST(l_orderkey AS STRING))
       ELSE concat('W', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) END AS property_id,
  s_name AS source_agency,
  concat('w', CAST(s AS STRING)) AS source_name,
  CASE WHEN s = 6 AND k % 13 = 0 THEN '2025-99-99' WHEN s = 6 AND k % 17 = 0 THEN 'abcd-efghi'
       WHEN s = 6 AND k % 19 = 0 THEN concat('  ', CAST(CAST(dd AS INT) AS STRING), '/', CAST(CAST(mm AS INT) AS STRING), '/', yy, ' ')
       WHEN s = 6 AND k % 23 = 0 THEN 'None' ELSE concat(yy, '-', mm, '-', dd) END AS feed_date,
  CASE WHEN o_orderstatus = 'F' THEN concat(oy, '-', om, '-', od) END AS sold_let_date,
  CASE WHEN o_orderstatus = 'F' THEN 'sale' ELSE 'RENTAL' END AS transaction_type,
  CASE WHEN k % 3 = 0 THEN 'under offer' ELSE 'Active' END AS listing_status,
  concat(CAST(l_partkey AS STRING), ' High Street, ', c_name) AS address,
  c_mktsegment AS area, s_name AS borough, concat('N', CAST(c_nationkey AS STRING)) AS postcode,
  CASE WHEN p_size % 2 = 0 THEN 'SEMI-DETACHED house' ELSE 'flat' END AS property_type,
  CASE WHEN k % 5 = 0 THEN 'N/A' ELSE 'Freehold' END AS tenure,
  CASE WHEN s = 6 AND k % 29 = 0 THEN '2.5' WHEN s = 6 AND k % 31 = 0 THEN ' 3 ' WHEN s = 6 AND k % 37 = 0 THEN '1e3'
       WHEN s = 6 AND k % 41 = 0 THEN '-0.5' ELSE CAST(p_size % 6 AS STRING) END AS bedrooms,
  CASE WHEN s = 6 AND k % 29 = 0 THEN '+2' WHEN s = 6 AND k % 31 = 0 THEN 'two' ELSE CAST(l_linenumber AS STRING) END AS bathrooms,
  CASE WHEN s = 6 AND k % 43 = 0 THEN 'NaN' WHEN s = 6 AND k % 47 = 0 THEN '-99999' WHEN k % 53 = 0 THEN '99998'
       WHEN s IN (5, 6) AND k % 7 = 0 THEN '-450.5' ELSE CAST(CAST(l_quantity AS BIGINT) * 30 + 100 AS STRING) END AS sqft,
  CASE WHEN s IN (4, 5, 6) AND k % 11 = 0 THEN concat('-', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING))
       ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END AS price,
  CAST(CAST(l_discount * 100 AS BIGINT) AS STRING) AS price_per_sqft,
  CASE WHEN p_size % 3 = 0 THEN 'NEEDS work' ELSE 'good' END AS `condition`,
  CASE WHEN k % 4 = 0 THEN '' ELSE 'C' END AS epc_rating,
  p_brand AS heating_type, CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS garden,
  CASE WHEN k % 9 = 0 THEN NULL ELSE 'No' END AS parking, CAST(p_size AS STRING) AS floor_level,
  CAST(k % 90 AS STRING) AS days_on_market, CAST(l_suppkey AS STRING) AS agent_id,
  l_returnflag AS is_chain_free,
  concat('-0.', CAST(k % 1000 AS STRING)) AS longitude, concat('51.', CAST(k % 1000 AS STRING)) AS latitude,
  o_orderpriority AS unit_no, 'p' AS partition_0
FROM (SELECT *, l_partkey + l_suppkey * 7 AS k, l_suppkey % 7 AS s,
        CAST(year(l_shipdate) AS STRING) AS yy, lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS mm,
        lpad(CAST(day(l_shipdate) AS STRING), 2, '0') AS dd,
        CAST(year(o_orderdate) AS STRING) AS oy, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS om,
        lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS od
      FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
           JOIN {supplier} u ON l.l_suppkey = u.s_suppkey JOIN {customer} c ON o.o_custkey = c.c_custkey) b
"""
TABLES = ("lineitem", "orders", "part", "supplier", "customer")
#: Registered, and without rows; registered, and not readable.
EMPTY_SOURCE = "w8"
UNREADABLE = {"w9": "Path does not exist: w9/raw-data"}
SHORT_HEADER = ("garden", "parking")  # not in the header of w4 and w5


def wide_feed_sql() -> str:
    text = WIDE_FEED_SELECT.replace("`condition`", '"condition"')
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def _joined(lineitem: DataFrame, orders: DataFrame, part: DataFrame, supplier: DataFrame, customer: DataFrame) -> DataFrame:
    """The joins of ``WIDE_FEED_SELECT``, the fewest bytes first: customers meet orders, not line items,
    and line items meet the small rows of parts and suppliers before the wide ones of orders."""
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
                    .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
                    .join(bought, F.col("l_orderkey") == F.col("o_orderkey")))


def wide_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in TABLES}
    select = WIDE_FEED_SELECT[:WIDE_FEED_SELECT.index("FROM {lineitem}")]
    return spark.sql(f"{select}FROM {{joined}}) b", joined=_joined(**tables))


def wide_columns(feed: DataFrame) -> dict[str, tuple[str, ...]]:
    """Each source's header."""
    names = [c for c in feed.columns if c != "source_name"]
    short = tuple(c for c in names if c not in SHORT_HEADER)
    return {f"w{k}": short if k in (4, 5) else tuple(names) for k in range(7)}
