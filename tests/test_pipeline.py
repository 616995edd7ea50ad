"""End to end on small invented CSV feeds shaped like the real ones."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.plans.pipeline import profile, run_etl
from feedlake.operators import validate_feeds
from feedlake.sinks import read_feed_table, write_feed
from feedlake.sources import read_feed_root

HEADER = ",".join(C.EXPECTED_COLUMNS)


def _line(pid, agency, feed_date, price="450000", sqft="800", bedrooms="2", ptype="Flat"):
    values = {
        "property_id": pid, "source_agency": agency, "feed_date": feed_date,
        "sold_let_date": "", "transaction_type": "Sale", "listing_status": "Active",
        "address": '"12 High Street, London"', "area": "Camden", "borough": "Camden",
        "postcode": "NW1 0AA", "property_type": ptype, "tenure": "Freehold",
        "bedrooms": bedrooms, "bathrooms": "1", "sqft": sqft, "price": price,
        "price_per_sqft": "560", "condition": "good", "epc_rating": "C",
        "heating_type": "Gas Central", "garden": "Yes", "parking": "No", "floor_level": "1",
        "days_on_market": "10", "agent_id": "AG1", "is_chain_free": "Yes",
        "longitude": "-0.14", "latitude": "51.53",
    }
    return ",".join(values[c] for c in C.EXPECTED_COLUMNS)


def _write(root, source, name, lines):
    d = os.path.join(root, source, "raw-data")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", newline="") as fh:
        fh.write("\r\n".join(lines) + ("\r\n" if lines else ""))


def make_feeds(root):
    # alpha: day-first slashes, a duplicate id across days, a negative price
    _write(root, "alpha", "Alpha_feed_20250106.csv",
           [HEADER, _line("A1", "Alpha", "06/01/2025"), _line("A2", "Alpha", "06/01/2025", price="-5")])
    _write(root, "alpha", "Alpha_feed_20250107.csv",
           [HEADER, _line("A1", "Alpha", "07/01/2025"), _line("A3", "Alpha", "07/01/2025")])
    _write(root, "alpha", "listings.csv", [""])
    # beta: month names, a placeholder sqft, semi-detached casing
    _write(root, "beta", "Beta_feed_20250106.csv",
           [HEADER, _line("B1", "Beta", "06 Jan 2025", sqft="99999", ptype="Semi-Detached"),
            _line("B2", "Beta", "06 Jan 2025", sqft="-200")])
    # gamma: a null id -> fails validation
    _write(root, "gamma", "Gamma_feed_20250106.csv",
           [HEADER, _line("", "Gamma", "2025-01-06"), _line("G2", "Gamma", "2025-01-06")])
    # delta: only the empty listings file -> no columns
    _write(root, "delta", "listings.csv", [""])
    return ["alpha", "beta", "gamma", "delta", "missing"]


def test_golden_pipeline(spark, tmp_dir):
    sources = make_feeds(tmp_dir)
    feeds = read_feed_root(spark, tmp_dir, sources)
    assert set(feeds.columns) == {"alpha", "beta", "gamma"}
    assert set(feeds.errors) == {"delta", "missing"}
    assert feeds.df.where("address = '12 High Street, London'").count() == 8

    prof = profile(feeds.df, feeds.columns, feeds.errors)
    scores = {r.source_name: (r.score, r.grade) for r in prof.scores.collect()}
    assert scores == {"alpha": (75, "GOOD"), "beta": (95, "EXCELLENT"), "gamma": (70, "FAIR"),
                      "delta": (0, "ERROR"), "missing": (0, "ERROR")}
    overall = prof.overall.collect()[0]
    assert overall.total_rows == 8 and overall.avg_score == 48.0

    out = os.path.join(tmp_dir, "out")
    res = run_etl(feeds.df, out, sources=feeds.sources, errors=feeds.errors,
                  ingestion_timestamp="2025-01-07 00:00:00", table="golden_feed")
    summary = {r.source_name: (r.rows, r.status) for r in res.summary.collect()}
    assert summary["alpha"] == (4, "SUCCESS") and summary["beta"] == (2, "SUCCESS")
    assert summary["gamma"] == (0, "FAILED: VALIDATION FAILED [gamma]: 1 null property IDs!")
    assert summary["delta"][0] == 0 and summary["delta"][1].startswith("FAILED: ")
    assert tuple(res.totals.collect()[0]) == (5, 3)
    counts = [tuple(r) for r in res.counts.collect()]
    assert counts == [("alpha", "2025-01-06", 2), ("alpha", "2025-01-07", 1), ("beta", "2025-01-06", 2)]

    table = spark.table("golden_feed")
    assert dict(table.dtypes)["feed_date"] == "string"
    b1 = table.where("property_id = 'B1'").collect()[0]
    assert b1.sqft is None and b1.property_type == "Semi-detached" and b1.price_per_sqft is None
    assert table.where("property_id = 'B2'").collect()[0].price_per_sqft == 2250.0
    # one row per source and id, the earliest date kept for A1
    assert table.where("property_id = 'A1'").collect()[0].feed_date == "2025-01-06"
    per_source = read_feed_table(spark, res.sources_path, partition_by=(C.SOURCE_COL, "feed_date"))
    assert per_source.count() == 5


def test_dynamic_overwrite_keeps_other_dates(spark, tmp_dir):
    df = spark.createDataFrame([("a", "2025-01-06", 1), ("b", "2025-01-07", 2)],
                               "id string, feed_date string, v int")
    path = os.path.join(tmp_dir, "t")
    write_feed(df, path)
    write_feed(spark.createDataFrame([("c", "2025-01-07", 3)], "id string, feed_date string, v int"), path)
    got = sorted(tuple(r) for r in read_feed_table(spark, path, partition_by=("feed_date",))
                 .select("id", "feed_date", "v").collect())
    assert got == [("a", "2025-01-06", 1), ("c", "2025-01-07", 3)]
    def files(folder):
        d = os.path.join(path, folder)
        return sorted((n, os.stat(os.path.join(d, n)).st_size, os.stat(os.path.join(d, n)).st_mtime_ns)
                      for n in os.listdir(d))
    before = files("feed_date=2025-01-06")
    write_feed(spark.createDataFrame([("d", "2025-01-07", 4)], "id string, feed_date string, v int"), path)
    assert files("feed_date=2025-01-06") == before
    write_feed(spark.createDataFrame([("e", "2025-01-08", 5)], "id string, feed_date string, v int"),
               path, overwrite="static")
    assert [r.id for r in read_feed_table(spark, path, partition_by=("feed_date",)).collect()] == ["e"]


def test_read_back_keeps_text_dates(spark, tmp_dir):
    df = spark.createDataFrame([("a", "2025-01-06"), ("b", None)], "id string, feed_date string")
    path = os.path.join(tmp_dir, "t")
    write_feed(df, path)
    back = read_feed_table(spark, path, partition_by=("feed_date",))
    assert dict(back.dtypes)["feed_date"] == "string"
    assert sorted((r.id, r.feed_date) for r in back.collect()) == [("a", "2025-01-06"), ("b", None)]


def test_incremental_rerun_equals_full_load(spark, tmp_dir):
    from feedlake.streaming.incremental import incremental_load

    sources = make_feeds(tmp_dir)
    feeds = read_feed_root(spark, tmp_dir, sources[:3])
    path = os.path.join(tmp_dir, "inc")
    incremental_load(feeds.df, path, ingestion_timestamp="t")
    full = sorted(tuple(r) for r in read_feed_table(spark, path).drop("ingestion_timestamp").collect())
    incremental_load(feeds.df, path, ingestion_timestamp="t", dates=["2025-01-07"])
    again = sorted(tuple(r) for r in read_feed_table(spark, path).drop("ingestion_timestamp").collect())
    assert full == again and len(full) == 5


def test_feed_stream_available_now(spark, tmp_dir):
    from feedlake.streaming.incremental import start_feed_stream

    raw = os.path.join(tmp_dir, "raw")
    _write(raw, "alpha", "Alpha_feed_20250106.csv",
           [HEADER, _line("A1", "Alpha", "06/01/2025"), _line("A2", "Alpha", "06/01/2025")])
    _write(raw, "alpha", "Alpha_feed_20250107.csv",
           [HEADER, _line("A1", "Alpha", "07/01/2025"), _line("A3", "Alpha", "07/01/2025")])
    _write(raw, "beta", "Beta_feed_20250106.csv",
           [HEADER, _line("B1", "Beta", "06 Jan 2025"), _line("B2", "Beta", "06 Jan 2025")])
    out, ckpt = os.path.join(tmp_dir, "stream-out"), os.path.join(tmp_dir, "stream-ckpt")
    start_feed_stream(spark, raw, out, ckpt, ingestion_timestamp="t").awaitTermination(120)
    got = read_feed_table(spark, out)
    assert got.count() == 5
    assert got.where(F.col("source_name") == "beta").count() == 2


def test_strict_header_matches_columns_by_name(spark, tmp_dir):
    cols = list(C.EXPECTED_COLUMNS)
    reordered = [cols[1], cols[0]] + cols[2:]
    line = _line("R1", "Reo", "2025-01-06").split(",")
    values = dict(zip(C.EXPECTED_COLUMNS, line[:6] + [",".join(line[6:8])] + line[8:]))
    _write(tmp_dir, "reo", "a.csv", [HEADER, _line("R0", "Reo", "2025-01-06")])
    _write(tmp_dir, "reo", "b.csv", [",".join(reordered), ",".join(values[c] for c in reordered)])
    _write(tmp_dir, "reo", "listings.csv", [""])
    strict = read_feed_root(spark, tmp_dir, ["reo"], strict_header=True)
    got = {r.property_id: r.source_agency for r in strict.df.collect()}
    assert got == {"R0": "Reo", "R1": "Reo"}
    assert {r.property_id for r in read_feed_root(spark, tmp_dir, ["reo"]).df.collect()} == {"R0", "R1"}
    loose = read_feed_root(spark, tmp_dir, ["reo"], strict_header=False)
    assert {r.property_id for r in loose.df.collect()} != {"R0", "R1"}   # read by position


def test_single_scan_reader_matches_per_source_reads(spark, tmp_dir):
    from feedlake.sources import read_feed_scan

    sources = make_feeds(tmp_dir)
    one = read_feed_scan(spark, tmp_dir, sources)
    assert set(one.errors) == {"missing", "delta"}
    assert set(one.columns) == {"alpha", "beta", "gamma"}
    per = read_feed_root(spark, tmp_dir, sources, strict_header=False)
    cols = list(C.EXPECTED_COLUMNS) + [C.SOURCE_COL]
    def rows(df):
        return sorted(tuple("" if v is None else v for v in r) for r in df.select(cols).collect())
    assert rows(one.df) == rows(per.df)
    plan = one.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    v = {r.source_name: r.message for r in validate_feeds(one.df, sources=one.sources).collect()}
    assert v["delta"] == "VALIDATION FAILED [delta]: No records found!" and v["alpha"] is None


def test_add_table_partitions_registers_only_new_folders(spark, tmp_dir):
    from feedlake.sinks import add_table_partitions, register_table, write_combined

    schema = "id string, feed_date string, source_name string"
    first = spark.createDataFrame([("a", "2025-01-06", "s1"), ("b", "2025-01-06", "s'2")], schema)
    path = os.path.join(tmp_dir, "tbl")
    write_combined(first, path)
    register_table(spark, "inc_tbl", path, first.schema)
    assert spark.table("inc_tbl").count() == 2
    new = spark.createDataFrame([("c", "2025-01-07", "s1")], schema)
    write_combined(new, path)
    assert spark.table("inc_tbl").count() == 2          # folder exists, table does not know it
    assert add_table_partitions(spark, "inc_tbl", new) == 1
    spark.catalog.refreshTable("inc_tbl")
    got = sorted((r.id, r.feed_date, r.source_name) for r in spark.table("inc_tbl").collect())
    assert got == [("a", "2025-01-06", "s1"), ("b", "2025-01-06", "s'2"), ("c", "2025-01-07", "s1")]


def test_incremental_etl_keeps_table_whole(spark, tmp_dir):
    sources = make_feeds(tmp_dir)
    feeds = read_feed_root(spark, tmp_dir, sources[:3])
    out = os.path.join(tmp_dir, "out")
    run_etl(feeds.df, out, ingestion_timestamp="t", table="inc_etl", dates=["2025-01-06"])
    assert spark.table("inc_etl").count() == 4
    res = run_etl(feeds.df, out, ingestion_timestamp="t", table="inc_etl", dates=["2025-01-07"])
    assert [tuple(r) for r in res.counts.collect()] == [
        ("alpha", "2025-01-06", 2), ("alpha", "2025-01-07", 1), ("beta", "2025-01-06", 2)]


def test_command_line(spark, tmp_dir, capsys):
    from feedlake.__main__ import main

    make_feeds(tmp_dir)
    report = os.path.join(tmp_dir, "report")
    assert main(["profile", tmp_dir, "--sources", "alpha,beta,gamma", "--report", report]) == 0
    assert spark.read.parquet(os.path.join(report, "scores")).count() == 3
    out = os.path.join(tmp_dir, "out")
    assert main(["etl", tmp_dir, out, "--sources", "alpha,beta,gamma", "--table", "cli_tbl"]) == 0
    assert spark.table("cli_tbl").count() == 5
    gated = os.path.join(tmp_dir, "gated")
    assert main(["etl", tmp_dir, gated, "--sources", "alpha,beta,gamma", "--min-score", "80"]) == 0
    assert main(["q1", os.path.join(out, "combined")]) == 0
    printed = capsys.readouterr().out
    assert "VALIDATION FAILED [gamma]: 1 null property IDs!" in printed


def test_quality_gate(spark, tmp_dir):
    sources = make_feeds(tmp_dir)
    feeds = read_feed_root(spark, tmp_dir, sources[:3])
    res = run_etl(feeds.df, os.path.join(tmp_dir, "out"), sources=feeds.sources,
                  ingestion_timestamp="t", min_score=80, columns_by_source=feeds.columns)
    summary = {r.source_name: r.status for r in res.summary.collect()}
    assert summary["beta"] == "SUCCESS"
    assert summary["alpha"] == "FAILED: QUALITY GATE [alpha]: score 75 below 80"
    assert summary["gamma"] == "FAILED: QUALITY GATE [gamma]: score 70 below 80"
    assert tuple(res.totals.collect()[0]) == (2, 1)


def test_feed_stream_bookmark_processes_only_new_files(spark, tmp_dir):
    from feedlake.streaming.incremental import start_feed_stream

    raw = os.path.join(tmp_dir, "raw")
    _write(raw, "alpha", "Alpha_feed_20250106.csv",
           [HEADER, _line("A1", "Alpha", "06/01/2025"), _line("A2", "Alpha", "06/01/2025")])
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    start_feed_stream(spark, raw, out, ckpt, ingestion_timestamp="t1").awaitTermination(120)
    day1 = os.path.join(out, "feed_date=2025-01-06", "source_name=alpha")
    files_day1 = sorted(os.listdir(day1))
    # nothing new: the bookmark skips the processed file
    start_feed_stream(spark, raw, out, ckpt, ingestion_timestamp="t2").awaitTermination(120)
    assert sorted(os.listdir(day1)) == files_day1
    # a new daily file: only its partition is written
    _write(raw, "alpha", "Alpha_feed_20250107.csv",
           [HEADER, _line("A3", "Alpha", "07/01/2025")])
    start_feed_stream(spark, raw, out, ckpt, ingestion_timestamp="t3").awaitTermination(120)
    assert sorted(os.listdir(day1)) == files_day1
    got = sorted((r.property_id, r.feed_date, r.ingestion_timestamp)
                 for r in read_feed_table(spark, out).collect())
    assert got == [("A1", "2025-01-06", "t1"), ("A2", "2025-01-06", "t1"), ("A3", "2025-01-07", "t3")]


def test_declared_schema_rejects_reordered_header(spark, tmp_dir):
    import pytest as _pytest

    from feedlake.streaming.incremental import raw_feed_schema

    cols = list(C.EXPECTED_COLUMNS)
    reordered = [cols[1], cols[0]] + cols[2:]
    _write(tmp_dir, "reo", "a.csv", [",".join(reordered), _line("R1", "Reo", "2025-01-06")])
    feeds = read_feed_root(spark, tmp_dir, ["reo"], schema=raw_feed_schema())
    with _pytest.raises(Exception, match="(?i)header|schema"):
        feeds.df.collect()


def test_source_folder_layout(spark, tmp_dir):
    from feedlake.sinks import write_source_folders

    sources = make_feeds(tmp_dir)
    feeds = read_feed_root(spark, tmp_dir, sources[:3])
    res = run_etl(feeds.df, os.path.join(tmp_dir, "out"), sources=feeds.sources, ingestion_timestamp="t")
    stored = read_feed_table(spark, res.sources_path, partition_by=(C.SOURCE_COL, "feed_date"))
    root = os.path.join(tmp_dir, "per-source")
    write_source_folders(stored, root, ["alpha", "beta"])
    folders = sorted(n for n in os.listdir(os.path.join(root, "alpha", "processed"))
                     if n.startswith("feed_date="))
    assert folders == ["feed_date=2025-01-06", "feed_date=2025-01-07"]
    alpha = read_feed_table(spark, os.path.join(root, "alpha", "processed"), partition_by=("feed_date",))
    assert alpha.count() == 3 and C.SOURCE_COL in alpha.columns


def _feed_rows(spark, rows):
    """(source, id, feed_date)"""
    from feedlake.streaming.incremental import raw_feed_schema
    schema = raw_feed_schema().add("source_name", "string")
    full = [tuple({"property_id": i, "feed_date": d, "price": "100", "sqft": "50"}.get(c) for c in C.EXPECTED_COLUMNS) + (s,)
            for s, i, d in rows]
    return spark.createDataFrame(full, schema)


def _stored(spark, path, schema=None):
    return sorted((r.source_name, r.property_id, r.feed_date) for r in read_feed_table(spark, path, schema).select(
        "source_name", "property_id", "feed_date").collect())


def test_stream_equals_full_load_and_records_failures(spark, tmp_dir):
    """Late rows, bad dates and a failing source, one file per batch."""
    from feedlake.streaming.incremental import start_feed_stream
    root, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))

    def run():
        start_feed_stream(spark, root, out, ckpt, max_files_per_trigger=1).awaitTermination()

    _write(root, "a", "d1.csv", [HEADER, _line("A1", "A", "06/01/2025"), _line("A2", "A", "junk")])
    _write(root, "b", "d1.csv", [HEADER, _line("B1", "B", "06/01/2025")])
    run()
    _write(root, "a", "d2.csv", [HEADER, _line("A3", "A", "06/01/2025"), _line("A4", "A", "bad"),
                                 _line("A5", "A", "09/01/2025")])
    run()
    assert _stored(spark, out) != []
    _write(root, "a", "d3.csv", [HEADER, _line("A5", "A", "07/01/2025")])     # moves the survivor
    _write(root, "b", "d2.csv", [HEADER, _line("", "B", "07/01/2025")])       # fails the gate from now on
    run()
    got = {(s, i): d for s, i, d in [(r.source_name, r.property_id, r.feed_date)
                                     for r in read_feed_table(spark, out).collect()]}
    assert got == {("a", "A1"): "2025-01-06", ("a", "A2"): None, ("a", "A3"): "2025-01-06", ("a", "A4"): None,
                   ("a", "A5"): "2025-01-07"}
    status = spark.read.parquet(out + "-status").where("NOT passed").collect()
    assert [r.source_name for r in status] == ["b"] and "null property IDs" in status[0].message


def test_run_etl_after_a_failure_and_a_late_row(spark, tmp_dir):
    first = _feed_rows(spark, [("a", "a1", "2025-01-09"), ("a", "a2", "2025-01-09"), ("b", "b1", "2025-01-09"),
                               ("c", "c1", "x")])
    second = _feed_rows(spark, [("a", "a1", "2025-01-07"), ("a", "a2", "2025-01-09"), ("a", "a1", "2025-01-09"),
                                ("b", "b1", "2025-01-09"), ("b", "", "2025-01-09"), ("c", "c1", "x")])
    out = os.path.join(tmp_dir, "out")
    run_etl(first, out, table="etl_after_failure")
    result = run_etl(second, out, table="etl_after_failure")
    full = run_etl(second, os.path.join(tmp_dir, "full"))
    expected = {("a", "a1", "2025-01-07"), ("a", "a2", "2025-01-09"), ("c", "c1", None)}
    for path in (result.combined_path, full.combined_path):
        rows = read_feed_table(spark, path).collect()
        assert {(r.source_name, r.property_id, r.feed_date) for r in rows} == expected and len(rows) == 3
    assert {r.source_name: r.status[:7] for r in result.summary.collect()} == {"a": "SUCCESS", "b": "FAILED:", "c": "SUCCESS"}
    assert spark.table("etl_after_failure").count() == 3                       # the null folder included
    assert sum(r.rows for r in result.counts.collect()) == 3
    spark.sql("DROP TABLE etl_after_failure")


def test_incremental_dates_rewrite_moved_survivors(spark, tmp_dir):
    from feedlake.streaming.incremental import incremental_load
    path = os.path.join(tmp_dir, "t")
    incremental_load(_feed_rows(spark, [("a", "a1", "2025-01-09"), ("a", "a2", "2025-01-08"), ("a", "a9", "y")]), path)
    both = _feed_rows(spark, [("a", "a1", "2025-01-09"), ("a", "a2", "2025-01-08"), ("a", "a1", "2025-01-07"),
                              ("a", "a9", "y")])
    incremental_load(both, path, dates=["2025-01-07"])
    rows = {(r.property_id, r.feed_date) for r in read_feed_table(spark, path).collect()}
    assert rows == {("a1", "2025-01-07"), ("a2", "2025-01-08"), ("a9", None)}


def test_dates_with_static_overwrite_is_refused(spark, tmp_dir):
    import pytest
    with pytest.raises(ValueError, match="erase"):
        run_etl(_feed_rows(spark, [("a", "a1", "2025-01-07")]), tmp_dir, dates=["2025-01-07"], overwrite="static")


def test_null_partition_is_registered(spark, tmp_dir):
    from feedlake.sinks import add_table_partitions, register_table, write_combined
    path = os.path.join(tmp_dir, "t")
    df = _feed_rows(spark, [("a", "a1", "2025-01-07"), ("a", "a2", None)]).select("property_id", "source_name", "feed_date")
    write_combined(df.where("feed_date IS NOT NULL"), path)
    register_table(spark, "null_part", path, df.schema)
    write_combined(df.where("feed_date IS NULL"), path)
    assert add_table_partitions(spark, "null_part", df.where("feed_date IS NULL")) == 1
    assert spark.table("null_part").count() == 2
    spark.sql("DROP TABLE null_part")


def test_many_writers_and_a_split_hot_folder(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(20_000).selectExpr("'s' AS source_name", "CASE WHEN id < 15000 THEN '2025-01-01' ELSE concat('d', id % 50) END AS feed_date",
                                        "concat('p', id) AS property_id")
    write_feed(df, path, ("feed_date", "source_name"), overwrite="static", writers=8)
    files = spark.read.parquet(path).selectExpr("feed_date", "_metadata.file_path AS f").distinct().collect()
    assert sum(r.feed_date is not None and str(r.feed_date) == "2025-01-01" for r in files) > 2
    assert len({r.f.rsplit("part-", 1)[1][:5] for r in files}) >= 6


def test_a_thousand_sources_are_one_scan(spark, tmp_dir):
    names = [f"s{k}" for k in range(1000)]
    reordered = [C.EXPECTED_COLUMNS[1], C.EXPECTED_COLUMNS[0], "unit_no", *C.EXPECTED_COLUMNS[2:]]
    for k, n in enumerate(names[:990]):
        if k % 2:
            _write(tmp_dir, n, "a.csv", [HEADER, _line(f"P{k}", "X", "2025-01-06")])
        else:
            _write(tmp_dir, n, "a.csv", [",".join(reordered), ",".join(["X", f"P{k}", "7", "2025-01-06"])])
    _write(tmp_dir, "s990", "listings.csv", [""])                          # nothing but an empty line
    _write(tmp_dir, "s991", "a.csv", ["agency,address", "X,Y"])            # no id column
    feeds = read_feed_root(spark, tmp_dir, names)
    plan = feeds.df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") <= 2                                          # one scan for each distinct header
    rows = feeds.df.select("source_name", "property_id", "source_agency", "feed_date", "unit_no").collect()
    assert len(rows) == 990
    assert all(r.property_id == "P" + r.source_name[1:] and r.source_agency == "X" and r.feed_date == "2025-01-06"
               and r.unit_no == (None if int(r.source_name[1:]) % 2 else "7") for r in rows)
    assert set(feeds.errors) == set(names[990:]) and "property_id" in feeds.errors["s991"]


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from feedlake.session import ensure_checkpoint_dir
    jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))
    session = SimpleNamespace(sparkContext=SimpleNamespace(_jsc=jsc, master="yarn"), conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_wide_sources_are_read(spark, tmp_dir):
    names = ["property_id", *(f"x{i}" for i in range(69)), "last"]
    for source, cols in (("wide", names), ("narrow", ["price", "property_id"])):
        folder = os.path.join(tmp_dir, source, "raw-data")
        os.makedirs(folder)
        with open(os.path.join(folder, "a.csv"), "w") as f:
            f.write(",".join(cols) + "\n" + ",".join(f"{source}-{c}" for c in cols) + "\n")
    feeds = read_feed_root(spark, tmp_dir, ["wide", "narrow"])
    assert feeds.errors == {} and feeds.columns["wide"] == tuple(names)
    rows = {r["source_name"]: r for r in feeds.df.collect()}
    assert len(rows) == 2 and all(rows["wide"][c] == f"wide-{c}" for c in names)
    assert rows["narrow"]["price"] == "narrow-price" and rows["narrow"]["last"] is None


def test_a_rerun_stores_its_rows_once_and_combines_without_a_shuffle(spark, tmp_dir, monkeypatch):
    from feedlake import session
    from feedlake.sinks import parquet

    named, dealt = [], []
    monkeypatch.setattr(parquet, "stored_copy", lambda df, name, *a: (named.append(name), session.stored_copy(df, name, *a))[1])
    real = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, *a: (dealt.append(a), real(df, *a))[1])
    first = [("a", f"a{k}", f"2025-01-{k % 9 + 1:02d}") for k in range(40)] + [("b", "b1", "x")]
    second = [*first, ("a", "a1", "2024-12-31"), ("b", "b1", "2025-01-01")]
    out = os.path.join(tmp_dir, "out")
    run_etl(_feed_rows(spark, first), out, ingestion_timestamp="t")
    assert len(dealt) == 1                                          # the per-source table, not the combined one
    result = run_etl(_feed_rows(spark, second), out, ingestion_timestamp="t")
    assert len(dealt) == 2 and named.count("processed") == 1
    assert not {"rewritten", "places", "touched"} & set(named)
    full = run_etl(_feed_rows(spark, second), os.path.join(tmp_dir, "full"), ingestion_timestamp="t")
    got, want = (sorted(map(str, read_feed_table(spark, p).collect())) for p in (result.combined_path, full.combined_path))
    assert got == want and len(got) == 41
