"""The incremental store: equal to a full load, published in one switch, resumable."""

from __future__ import annotations

import os
import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.operators import validate_feeds
from feedlake.plans.pipeline import process
from feedlake.sinks import remove_folders
from feedlake.sinks.versions import current_version, folders, publish, replace_folders, vacuum, write_run
from feedlake.streaming import store as S
from feedlake.streaming.store import FeedStore, start_store_stream

from .test_pipeline import HEADER, _feed_rows, _line, _write


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: a file more is what a test here waits for."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def table(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def full_load(spark, rows, ts="t"):
    return process(_feed_rows(spark, rows), ingestion_timestamp=ts)


def random_days(seed, n_days):
    """Rows that repeat and move ids, with odd dates, odd sources, and one source that fails at last."""
    r = random.Random(seed)
    dates = ["2025-01-06", "07/01/2025", "2025/01/08", "junk", None, "9 Jan 2025", "2025-01-10"]
    days = []
    for day in range(n_days):
        rows = [(r.choice(["a", "b b", "c%2F+d", "é"]), f"p{r.randint(0, 25)}", r.choice(dates)) for _ in range(r.randint(1, 30))]
        if day == n_days - 1:
            rows.append(("b b", r.choice(["", None]), "2025-01-06"))
        days.append(rows)
    return days


def test_batches_equal_a_full_load(spark, tmp_dir):
    store = FeedStore(spark, os.path.join(tmp_dir, "store"))
    seen = []
    for k, rows in enumerate(random_days(1, 3)):
        seen += rows
        assert store.apply(_feed_rows(spark, rows), ingestion_timestamp="t") == k + 1
        whole = full_load(spark, seen)
        assert table(store.read()) == table(whole)
        want = validate_feeds(_feed_rows(spark, seen))
        assert table(store.validation()) == table(want)
    assert store.read(2).count() > 0                                     # an earlier version is still there
    assert vacuum(spark, store.root) > 0 and vacuum(spark, store.root) == 0
    assert table(store.read()) == table(full_load(spark, seen))
    status = {(x["batch"], x["stage"]): x["status"] for x in store.ledger().collect()}
    assert status == {(b, s): "done" for b in range(1, 4) for s in S.STAGES}


def test_a_batch_reads_no_other_folder_and_no_older_rows(spark, tmp_dir):
    store = FeedStore(spark, os.path.join(tmp_dir, "store"))
    store.apply(_feed_rows(spark, [("a", f"a{k}", f"2025-01-{6 + k % 9:02d}") for k in range(90)]))
    before = {(x["feed_date"], x["folder"]) for x in folders(spark, store.root).collect()}
    # All folders but one are taken away: a batch that needs them would fail.
    for date, folder in before:
        if date != "2025-01-07":
            shutil.rmtree(os.path.join(store.root, folder))
    store.apply(_feed_rows(spark, [("a", "a1", "2025-01-07"), ("a", "new", "2025-02-01")]))
    after = {(x["feed_date"], x["folder"]) for x in folders(spark, store.root).collect()}
    assert {d for d, f in after - before} == {"2025-01-07", "2025-02-01"} or {d for d, f in after - before} == {"2025-02-01"}
    assert {x for x in before if x[0] != "2025-01-07"} <= after
    # A row that is no new survivor touches nothing.
    store.apply(_feed_rows(spark, [("a", "new", "2025-03-01")]))
    assert {(x["feed_date"], x["folder"]) for x in folders(spark, store.root).collect()} == after


def test_a_stop_between_the_steps_leaves_one_version(spark, tmp_dir, monkeypatch):
    store = FeedStore(spark, os.path.join(tmp_dir, "store"))
    first = [("a", "a1", "2025-01-09"), ("a", "a2", "2025-01-08"), ("b", "b1", "2025-01-09")]
    second = [("a", "a1", "2025-01-07"), ("b", "", "2025-01-09")]         # a survivor moves, a source fails
    store.apply(_feed_rows(spark, first), ingestion_timestamp="t")
    old, new = table(full_load(spark, first)), table(full_load(spark, first + second))
    done = []
    real = {n: getattr(FeedStore, n) for n in ("_write_index", "_write_metrics", "_write_changed", "_publish")}

    def counted(name):
        def run(self, *args):
            done.append(name)
            return real[name](self, *args)
        return run
    for name in real:
        monkeypatch.setattr(FeedStore, name, counted(name))

    def stop(*args, **kw):
        raise RuntimeError("the run stops here")
    # The data is written and the list is not.
    monkeypatch.setattr("feedlake.sinks.versions.publish", stop)
    with pytest.raises(RuntimeError):
        store.apply(_feed_rows(spark, second), 2, "t", "v2")
    assert current_version(spark, store.root) == 1 and table(store.read()) == old
    assert os.path.isdir(os.path.join(store.root, "data", "run=2"))
    failed = store.ledger().where("status = 'failed'").collect()
    assert [(x["batch"], x["stage"], x["input_version"]) for x in failed] == [(2, "publish", "v2")]
    assert "the run stops here" in failed[0]["details"]
    # The repeated batch goes on at the stage that failed.
    monkeypatch.setattr("feedlake.sinks.versions.publish", publish)
    done.clear()
    store.apply(_feed_rows(spark, second), 2, "t", "v2")
    assert done == ["_publish"] and table(store.read()) == new
    done.clear()
    store.apply(_feed_rows(spark, second), 2, "t", "v2")                  # published: nothing to do
    assert done == [] and table(store.read()) == new
    # Another input of a batch that stopped begins again.
    monkeypatch.setattr(FeedStore, "_write_changed", stop)
    third = [("a", "a3", "2025-01-07")]
    with pytest.raises(RuntimeError):
        store.apply(_feed_rows(spark, [("z", "z", "x")]), 3, "t", "v3")
    assert table(store.read()) == new
    monkeypatch.setattr(FeedStore, "_write_changed", counted("_write_changed"))
    done.clear()
    store.apply(_feed_rows(spark, third), 3, "t", "v3 corrected")
    assert done == ["_write_index", "_write_metrics", "_write_changed", "_publish"]
    assert table(store.read()) == table(full_load(spark, first + second + third))


def test_numbers_columns_and_empty_batches(spark, tmp_dir):
    store = FeedStore(spark, os.path.join(tmp_dir, "store"))
    assert store.read().count() == 0 and store.validation().count() == 0 and store.ledger().count() == 0
    with pytest.raises(ValueError, match="does not follow"):
        store.apply(_feed_rows(spark, [("a", "a1", "x")]), 5)
    with pytest.raises(ValueError, match="own_column"):
        store.apply(_feed_rows(spark, [("a", "a1", "x")]).withColumn("own_column", F.lit("x")))
    assert store.apply(_feed_rows(spark, [])) == 1 and store.read().count() == 0
    assert store.apply(_feed_rows(spark, [("a", "a1", "2025-01-06")]).select("source_name", "feed_date", "property_id")) == 2
    (row,) = store.read().collect()
    assert row["property_id"] == "a1" and row["price"] is None
    with pytest.raises(ValueError, match="is not after"):
        publish(store.root, 2, folders(spark, store.root))


def test_stream_into_the_store_equals_a_full_load(spark, tmp_dir):
    root, ckpt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "ckpt")
    store = FeedStore(spark, os.path.join(tmp_dir, "store"))

    def run():
        start_store_stream(store, root, ckpt, ingestion_timestamp="t", max_files_per_trigger=1).awaitTermination()

    _write(root, "a", "d1.csv", [HEADER, _line("A1", "A", "06/01/2025"), _line("A2", "A", "junk")])
    _write(root, "b", "d1.csv", [HEADER, _line("B1", "B", "06/01/2025")])
    run()
    assert current_version(spark, store.root) == 2 and store.read().count() == 3
    _write(root, "a", "d2.csv", [HEADER, _line("A5", "A", "09/01/2025")])
    run()
    _write(root, "a", "d3.csv", [HEADER, _line("A5", "A", "07/01/2025")])     # moves the survivor
    _write(root, "b", "d2.csv", [HEADER, _line("", "B", "07/01/2025")])       # fails the gate from now on
    run()
    got = {(r.source_name, r.property_id): r.feed_date for r in store.read().collect()}
    assert got == {("a", "A1"): "2025-01-06", ("a", "A2"): None, ("a", "A5"): "2025-01-07"}
    failed = store.validation().where("NOT passed").collect()
    assert [r.source_name for r in failed] == ["b"] and "null property IDs" in failed[0].message
    run()                                                                      # no new file: no batch
    assert current_version(spark, store.root) == 5


def test_versions_of_a_table(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    rows = spark.createDataFrame([("x", "2025-01-06", "s"), ("y", None, "s"), ("z", "2025-01-06", "q{1}*[a]")],
                                 "v string, feed_date string, source_name string")
    assert vacuum(spark, root) == 0
    publish(root, 1, write_run(rows, root, 1))
    from feedlake.sinks.versions import read_version
    assert table(read_version(spark, root, rows.schema)) == table(rows)
    some = rows.where("v = 'y'")
    replace_folders(spark, root, 2, some.withColumn("v", F.lit("new")), some.select("feed_date", "source_name"),
                    rows.where("v = 'z'").select("feed_date", "source_name"))
    got = {(r.v, r.feed_date, r.source_name) for r in read_version(spark, root, rows.schema).collect()}
    assert got == {("x", "2025-01-06", "s"), ("new", None, "s")}
    assert table(read_version(spark, root, rows.schema, 1)) == table(rows)
    # Data of a run that is in the making is not removed.
    write_run(some, root, 3)
    assert vacuum(spark, root, keep_versions=2) == 0 and vacuum(spark, root) == 2
    assert os.path.isdir(os.path.join(root, "data", "run=3"))


def test_folders_are_removed_on_executors(spark, tmp_dir):
    paths = [os.path.join(tmp_dir, f"d={k} %2F+x", "s") for k in range(150)]
    for p in paths:
        os.makedirs(p)
        open(os.path.join(p, "f"), "w").close()
    named = spark.createDataFrame([(f"file:{p}",) for p in paths] + [(os.path.join(tmp_dir, "not there"),)], "folder string")
    assert remove_folders(spark, named) == 150
    assert not any(os.path.exists(p) for p in paths) and remove_folders(spark, named) == 0
    assert remove_folders(spark, named.limit(0)) == 0


def test_columns_of_the_store_are_those_it_was_opened_with(spark, tmp_dir):
    columns = [*C.EXPECTED_COLUMNS, "unit_no"]
    store = FeedStore(spark, os.path.join(tmp_dir, "store"), columns)
    store.apply(_feed_rows(spark, [("a", "a1", "2025-01-06")]).withColumn("unit_no", F.lit("7")))
    store.apply(_feed_rows(spark, [("a", "a2", "2025-01-06")]))
    assert {(r.property_id, r.unit_no) for r in store.read().collect()} == {("a1", "7"), ("a2", None)}


def test_a_daily_run_from_files_to_sql(spark, tmp_dir, capsys):
    from feedlake.__main__ import main
    from feedlake.plans.store_run import run_store
    from feedlake.sources import read_feed_root

    day1, day2, root = (os.path.join(tmp_dir, x) for x in ("d1", "d2", "store"))
    _write(day1, "alpha", "f.csv", [HEADER, _line("A1", "A", "06/01/2025"), _line("A2", "A", "07/01/2025"), "A3,A"])
    _write(day1, "beta", "f.csv", [HEADER, _line("B1", "B", "06/01/2025")])
    _write(day2, "alpha", "f.csv", [HEADER, _line("A2", "A", "05/01/2025")])
    _write(day2, "beta", "f.csv", [HEADER, _line("", "B", "07/01/2025")])
    store = FeedStore(spark, root)
    first = run_store(read_feed_root(spark, day1, ["alpha", "beta", "gone"]), store, ingestion_timestamp="t", table="daily_run")
    assert {(r.source_name, r.rows, r.malformed_rows) for r in first.summary.collect()} == {
        ("alpha", 3, 1), ("beta", 1, 0), ("gone", 0, 0)}
    assert [r.line for r in first.quarantine.collect()] == ["A3,A"]
    assert {(r.source_name, r.status) for r in first.summary.collect() if r.source_name == "gone"} == {
        ("gone", "FAILED: no files under " + os.path.join(day1, "gone", "raw-data", ""))}
    assert spark.table("daily_run").count() == 4
    assert main(["load", day2, root, "--sources", "alpha,beta", "--table", "daily_run", "--batch", "2"]) == 0
    assert "null property IDs" in capsys.readouterr().out
    got = {(r.property_id, r.feed_date) for r in spark.sql("SELECT * FROM daily_run").collect()}
    assert got == {("A1", "2025-01-06"), ("A2", "2025-01-05"), ("A3", None)}
    assert main(["load", day2, root, "--sources", "alpha,beta", "--table", "daily_run", "--batch", "2"]) == 0  # repeated
    assert spark.table("daily_run").count() == 3
    assert {(r.batch, r.source_name, r.passed) for r in store.status().collect()} == {
        (1, "alpha", True), (1, "beta", True), (2, "alpha", True), (2, "beta", False)}


def test_the_sql_table_switches_once(spark, tmp_dir, monkeypatch):
    from feedlake.sinks import versions as V

    root = os.path.join(tmp_dir, "t")
    schema = "v string, feed_date string, source_name string"
    one = spark.createDataFrame([("x", "2025-01-06", "it's"), ("y", None, "s")], schema)
    assert V.register_version(spark, "switched", root, one.schema) is None
    publish(root, 1, write_run(one, root, 1))
    assert V.register_version(spark, "switched", root, one.schema) == 1
    assert table(spark.table("switched")) == table(one)
    two = spark.createDataFrame([("z", "2025-01-06", "it's")], schema)
    replace_folders(spark, root, 2, two, two.select("feed_date", "source_name"))
    real = V.add_table_partitions

    def stop(*args):
        real(*args)
        raise RuntimeError("stopped before the switch")
    monkeypatch.setattr(V, "add_table_partitions", stop)
    with pytest.raises(RuntimeError):
        V.register_version(spark, "switched", root, one.schema)
    assert table(spark.table("switched")) == table(one)                   # the old version, whole
    monkeypatch.setattr(V, "add_table_partitions", real)
    assert V.register_version(spark, "switched", root, one.schema) == 2
    assert {r.v for r in spark.table("switched").collect()} == {"y", "z"}
    replace_folders(spark, root, 3, two.where("false"), two.select("feed_date", "source_name"))
    assert V.register_version(spark, "switched", root, one.schema) == 3
    assert {r.v for r in spark.table("switched").collect()} == {"y"}
    names = {r.tableName for r in spark.sql("SHOW TABLES LIKE 'switched*'").collect()}
    assert names == {"switched", "switched__v2", "switched__v3"}


def test_the_first_batch_keeps_no_second_copy_of_its_index(spark, tmp_dir):
    store = FeedStore(spark, os.path.join(tmp_dir, "store"))
    days = [[("a", "a1", "2025-01-09"), ("a", "a2", None)], [("a", "a1", "2025-01-07"), ("b", "b1", "2025-01-07")]]
    for rows in days:
        store.apply(_feed_rows(spark, rows), ingestion_timestamp="t")
    assert os.listdir(os.path.join(store.root, "state", "changed")) == ["batch=2"]
    assert table(store.read()) == table(full_load(spark, days[0] + days[1]).select(*store.schema.names))


def test_a_folders_path_is_worked_on_once_per_file(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    rows = full_load(spark, [("a+b c", f"p{k}", "2025-01-09") for k in range(50)])
    named = write_run(rows, root, 1)
    assert [os.path.isdir(os.path.join(root, r["folder"])) for r in named.collect()] == [True]
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in plan and "_metadata" not in plan


def test_few_tasks_list_many_folders(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    rows = full_load(spark, [("a", f"p{k}", f"2025-{k // 28 + 1:02d}-{k % 28 + 1:02d}") for k in range(100)])
    publish(root, 1, write_run(rows, root, 1))
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, tracker = spark.conf.get(key), spark.sparkContext.statusTracker()
    seen = set(tracker.getJobIdsForGroup(None))
    got = S.read_version(spark, root, rows.schema)
    tasks = [tracker.getStageInfo(s).numTasks for j in set(tracker.getJobIdsForGroup(None)) - seen
             for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert tasks and max(tasks) < 50 and spark.conf.get(key) == before
    assert got.count() == 100
