"""Results stay whole and exact when one source and one id dominate."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.operators import dedupe, duplicate_keys, feed_counts, validate_feeds


def _skewed(spark, n=60_000):
    # src-hot holds two thirds of the rows; within it one id (H) holds half
    # of its rows, and 500 rows have no id at all.
    base = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit("src-hot"))
         .otherwise(F.concat(F.lit("src"), (F.col("id") % 7).cast("string"))).alias("source_name"),
        F.col("id"))
    return base.select(
        "source_name",
        F.when((F.col("source_name") == "src-hot") & (F.col("id") % 2 == 0), F.lit("H"))
         .when((F.col("source_name") == "src-hot") & (F.col("id") % 79 == 1), F.lit(None))
         .otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("property_id"),
        F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 9).cast("int")),
                      "yyyy-MM-dd").alias("feed_date"),
        F.col("id").cast("string").alias("price"),
    )


def test_skewed_dedupe_and_counts_are_exact(spark):
    df = _skewed(spark)
    rows = [(r.source_name, r.property_id, r.feed_date, int(r.price)) for r in df.collect()]
    keep = {}
    for src, pid, fd, price in rows:
        cur = keep.get((src, pid))
        cand = (fd, str(price))
        if cur is None or cand < cur:
            keep[(src, pid)] = cand
    got = {(r.source_name, r.property_id): (r.feed_date, r.price)
           for r in dedupe(df, order_by="all").collect()}
    assert got == keep

    want_counts = {}
    for (src, _), (fd, _) in keep.items():
        want_counts[(src, fd)] = want_counts.get((src, fd), 0) + 1
    counts = {(r.source_name, r.feed_date): r.rows
              for r in feed_counts(dedupe(df, order_by="all")).collect()}
    assert counts == want_counts


def test_skewed_duplicates_and_validation(spark):
    df = _skewed(spark)
    top = [tuple(r) for r in duplicate_keys(df, k=2).where("source_name = 'src-hot'")
           .select("property_id", "occurrences", "rank").collect()]
    n_hot = df.where("source_name = 'src-hot'").count()
    n_h = df.where("property_id = 'H'").count()
    n_null = df.where("property_id IS NULL").count()
    assert top == [("H", n_h, 1), (None, n_null, 2)]
    v = {r.source_name: r for r in validate_feeds(df).collect()}
    assert v["src-hot"].total_rows == n_hot
    assert v["src-hot"].duplicate_ids == (n_h - 1) + (n_null - 1)
    assert not v["src-hot"].passed and v["src3"].passed
