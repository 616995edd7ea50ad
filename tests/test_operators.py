"""Operators on inline rows: clean, enrich, dedupe, validate, profile, score."""

from __future__ import annotations

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

RAW = ("property_id string, source_name string, feed_date string, sold_let_date string, "
       "transaction_type string, listing_status string, property_type string, tenure string, "
       "bedrooms string, bathrooms string, sqft string, price string")


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def _row(pid, src, fd="2025-01-06", sqft="500", price="1000", bed="2", bath="1",
         ptype="Flat", status="Active"):
    return (pid, src, fd, None, "Sale", status, ptype, "N/A", bed, bath, sqft, price)


def test_clean_types_and_rules(ansi_spark):
    df = _raw(ansi_spark, [_row("a", "s", fd="06/01/2025", sqft="-200", price="-5", bed="-1",
                                bath="2.5")])
    out = clean(df).collect()[0]
    assert out.feed_date == "2025-01-06"
    assert out.sqft == 200.0 and out.price == 5.0
    assert out.bedrooms is None and out.bathrooms == 2
    types = dict(clean(df).dtypes)
    assert types["sqft"] == "double" and types["bedrooms"] == "int"
    assert types["tenure"] == "string"


def test_enrich_columns(spark):
    df = clean(_raw(spark, [_row("a", "s", sqft="0", ptype="semi-DETACHED", status="UNDER OFFER"),
                            _row("b", "s", sqft="400", price="1000")]))
    out = {r.property_id: r for r in enrich(df, "2025-01-07 00:00:00").collect()}
    assert out["a"].price_per_sqft is None
    assert out["b"].price_per_sqft == 2.5
    assert out["a"].property_type == "Semi-detached"
    assert out["a"].listing_status == "Under Offer"
    assert out["a"].tenure == "N/A"
    assert out["a"].ingestion_timestamp == "2025-01-07 00:00:00"


def test_enrich_drops_leftovers(spark):
    df = spark.createDataFrame([("a", "x", "y")], "property_id string, partition_0 string, partition_1 string")
    assert enrich(df, "t").columns == ["property_id", C.INGESTION_COL]


def test_duplicate_count_null_group(spark):
    df = spark.createDataFrame([(i, "s") for i in ["a", "a", None, None, ""]],
                               "property_id string, source_name string")
    v = validate_feeds(df).collect()[0]
    assert v.total_rows == 5 and v.duplicate_ids == 2 and v.null_ids == 3


def test_dedupe_first_is_total_order(spark):
    rows = [_row("a", "s1", fd="2025-01-07"), _row("a", "s1", fd="2025-01-06"),
            _row("a", "s1", fd=None), _row("a", "s2", fd="2025-01-08"),
            _row(None, "s1", fd="2025-01-09"), _row(None, "s1", fd="2025-01-05")]
    out = {(r.source_name, r.property_id): r.feed_date
           for r in dedupe(clean(_raw(spark, rows)), order_by="all").collect()}
    assert out == {("s1", "a"): None, ("s2", "a"): "2025-01-08", ("s1", None): "2025-01-05"}


def test_dedupe_any_keeps_one_per_key(spark):
    rows = [_row("a", "s1"), _row("a", "s1", fd="2025-01-07"), _row("a", "s2"), _row("b", "s1")]
    out = dedupe(_raw(spark, rows))
    assert out.count() == 3
    assert out.columns == _raw(spark, rows).columns


def test_duplicate_keys_top_k(spark):
    rows = ([_row("a", "s")] * 4 + [_row("b", "s")] * 2 + [_row("c", "s")] * 2
            + [_row("d", "s")] + [_row("e", "t")] * 3)
    out = [(r.source_name, r.property_id, r.occurrences, r["rank"])
           for r in duplicate_keys(_raw(spark, rows), k=2).orderBy("source_name", "rank").collect()]
    assert out == [("s", "a", 4, 1), ("s", "b", 2, 2), ("t", "e", 3, 1)]


def test_validate_messages_and_summary(spark):
    rows = [_row("a", "good", price="-3"), _row("a", "good"), _row(None, "bad"), _row("", "bad"),
            _row("x", "bad")]
    v = {r.source_name: r for r in validate_feeds(_raw(spark, rows), sources=["good", "bad", "empty"],
                                                  errors={"broken": "path missing"}).collect()}
    assert v["good"].passed and v["good"].negative_prices == 1 and v["good"].duplicate_ids == 1
    assert not v["bad"].passed
    assert v["bad"].message == "VALIDATION FAILED [bad]: 2 null property IDs!"
    assert v["empty"].message == "VALIDATION FAILED [empty]: No records found!"
    assert v["broken"].message == "path missing"
    summary = {r.source_name: (r.rows, r.status) for r in pipeline_summary(
        validate_feeds(_raw(spark, rows), sources=["good", "bad", "empty"])).collect()}
    assert summary["good"] == (2, "SUCCESS")
    assert summary["bad"] == (0, "FAILED: VALIDATION FAILED [bad]: 2 null property IDs!")
    assert summary["empty"] == (0, "FAILED: VALIDATION FAILED [empty]: No records found!")


def test_schema_check_and_stats(spark):
    base = _raw(spark, [_row("a", "s")])
    df = base.withColumn("extra_col", base["price"])
    issues = {(r.column_name, r.issue) for r in schema_check(df).collect()}
    assert ("extra_col", "extra") in issues and ("address", "missing") in issues
    assert ("price", "missing") not in issues
    by_source = {"s1": list(C.EXPECTED_COLUMNS), "s2": [c for c in C.EXPECTED_COLUMNS if c != "area"]}
    issues = [tuple(r) for r in schema_check(df, by_source).collect()]
    assert issues == [("s2", "area", "missing")]
    stats = source_stats(df).collect()[0]
    assert stats.rows == 1 and stats.column_count == len(df.columns) - 1


def test_numeric_profile(spark):
    rows = [_row("a", "s", sqft="-200", price="x"), _row("b", "s", sqft="0", price="10"),
            _row("c", "s", sqft="300", price="")]
    out = {r.column_name: r for r in numeric_profile(_raw(spark, rows)).collect()}
    assert out["sqft"].negatives == 1 and out["sqft"].zeros == 1
    assert out["sqft"].min_value == -200.0 and out["sqft"].max_value == 300.0
    assert out["sqft"].avg_value == 33.33
    assert out["price"].non_numeric == 2 and out["price"].has_non_numeric


def test_null_profile_pct_and_flag(spark):
    rows = [_row("a", "s", sqft="")] + [_row(str(i), "s") for i in range(19)]
    out = {r.column_name: r for r in null_profile(_raw(spark, rows)).collect()}
    assert out["sqft"].empty_count == 1 and out["sqft"].pct == 5.0 and out["sqft"].flag == C.ICON_INFO
    assert out["sold_let_date"].pct == 100.0 and out["sold_let_date"].flag == C.ICON_WARN
    assert "price" not in out


def test_category_and_date_profiles(spark):
    rows = [_row("a", "s", fd="06/01/2025"), _row("b", "s", fd="junk"), _row("c", "s", fd="")]
    cats = {(r.column_name, r.value): r.n_rows for r in category_profile(_raw(spark, rows)).collect()}
    assert cats[("tenure", "N/A")] == 3 and cats[("transaction_type", "Sale")] == 3
    dates = {(r.column_name, r.date_format): (r.n_rows, r.sample_value)
             for r in date_format_profile(_raw(spark, rows)).collect()}
    assert dates[("feed_date", "DD/MM/YYYY")] == (1, "06/01/2025")
    assert dates[("feed_date", "UNKNOWN")] == (1, "junk")
    assert dates[("feed_date", "empty")][0] == 1
    assert dates[("sold_let_date", "empty")] == (3, None)


def test_quality_scores_and_overall(spark):
    full = list(C.EXPECTED_COLUMNS)
    rows = [_row("a", "clean"), _row("a", "dupes"), _row("a", "dupes", sqft="-1"),
            _row(None, "nulls", price="-2")]
    by_source = {"clean": full, "dupes": full, "nulls": full[:-1]}
    scores = {r.source_name: r for r in quality_scores(
        _raw(spark, rows), by_source, errors={"gone": "no columns found"}).collect()}
    assert (scores["clean"].score, scores["clean"].grade, scores["clean"].icon) == (100, "EXCELLENT", C.ICON_OK)
    assert scores["dupes"].score == 75 and scores["dupes"].grade == "GOOD"
    assert scores["dupes"].issues == "Duplicate IDs (-20); Negative sqft (-5)"
    assert scores["nulls"].score == 45 and scores["nulls"].grade == "POOR"
    assert scores["gone"].score == 0 and scores["gone"].grade == "ERROR"
    assert scores["gone"].status == "FAILED: no columns found"
    overall = quality_overall(quality_scores(_raw(spark, rows), by_source,
                                             errors={"gone": "x"})).collect()[0]
    assert overall.total_rows == 4 and overall.avg_score == 55.0
    assert overall.grade == "POOR" and overall.advice == C.ADVICE_STOP


def test_counts_pivot_and_union(spark):
    rows = [_row("a", "s1", fd="2025-01-06"), _row("b", "s1", fd="2025-01-07"),
            _row("c", "s2", fd="2025-01-06")]
    counts = feed_counts(_raw(spark, rows))
    assert [tuple(r) for r in counts.collect()] == [("s1", "2025-01-06", 1), ("s1", "2025-01-07", 1),
                                                   ("s2", "2025-01-06", 1)]
    piv = [tuple(r) for r in pivot_counts(counts, "feed_date").collect()]
    assert piv == [("s1", 1, 1), ("s2", 1, 0)]
    a = _raw(spark, rows[:1])
    b = _raw(spark, rows[1:]).drop("tenure")
    u = combine_sources([a, b])
    assert u.count() == 3 and u.where("tenure IS NULL").count() == 2
    assert combine_sources([]) is None
