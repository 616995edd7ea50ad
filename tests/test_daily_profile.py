"""Profiles merged from days, ranks within groups, and a run's generated code."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlake.operators import rank_within
from feedlake.plans.daily_profile import ProfileStore
from feedlake.plans.pipeline import profile
from feedlake.sources.fixture import listing_feed

from .conftest import ROOT, SF_SMALL

REPORTS = ("stats", "schema", "duplicates", "numeric", "nulls", "scores", "dates", "categories", "date_samples", "overall")


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_days_merge_to_the_full_profile(spark, tmp_dir):
    feed = listing_feed(spark, SF_SMALL)
    columns = [c for c in feed.columns if c != "source_name"]
    headers = {f"src{k}": tuple(c for c in columns if k != 3 or c not in ("tenure", "sold_let_date")) for k in range(10)}
    store = ProfileStore(spark, os.path.join(tmp_dir, "p"), columns)
    day = F.pmod(F.xxhash64("property_id", "price"), F.lit(4))
    parts = [feed.where(day == k) for k in range(3)] + [feed.where((day == 3) & (F.col("source_name") != "src5"))]
    for k, part in enumerate(parts):
        store.add(f"d{k}", part)
    store.add("d1", parts[1])                                     # added again: replaced, not counted twice
    for upto, by_source in ((2, None), (4, headers)):
        whole = parts[0]
        for part in parts[1:upto]:
            whole = whole.unionByName(part)
        want = profile(whole, by_source)
        got = store.profile([f"d{k}" for k in range(upto)], by_source)
        for name in REPORTS:
            assert rows(getattr(got, name)) == rows(getattr(want, name)), name


def test_a_further_day_reads_no_other_days_rows(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "raw")
    feed = listing_feed(spark, SF_SMALL)
    store = ProfileStore(spark, os.path.join(tmp_dir, "p"), [c for c in feed.columns if c != "source_name"])
    feed.where("source_name = 'src1'").write.parquet(f"{folder}/one")
    feed.where("source_name = 'src2'").write.parquet(f"{folder}/two")
    store.add("one", spark.read.parquet(f"{folder}/one"))
    store.add("two", spark.read.parquet(f"{folder}/two"))
    merged = store.profile(["one", "two"])
    files = merged.scores.inputFiles() + merged.duplicates.inputFiles() + merged.dates.inputFiles()
    assert files and not any("/raw/" in f for f in files)
    with pytest.raises(ValueError, match="three"):
        store.profile(["one", "three"])
    assert store.profile([]).scores.count() == 0


def test_ranks_of_groups_with_ties_and_nulls(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), r.choice([None, *"klmnopq"]), k) for k in range(400)]
    data += [("hot", f"v{k:06d}", k) for k in range(20_000)] + [("one", None, 0)]
    df = spark.createDataFrame(data, "g string, v string, span int").repartition(5)
    out = rank_within(df, ["g"], ["v"], parts=7)
    got = out.withColumn("task", F.spark_partition_id()).collect()
    assert Counter((x.g, x.v, x.span) for x in got) == Counter(data)
    for g in ("a", "b", None, "hot", "one"):
        mine = sorted((x.rank, x.v) for x in got if x.g == g) if g != "a" else sorted(
            ((x.rank, x.v) for x in got if x.g == g), key=lambda p: p[0])
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert [v for _, v in mine] == sorted((v for _, v in mine), key=lambda v: (v is not None, v or ""))
    assert rank_within(df.limit(0), ["g"], ["v"]).collect() == []


def test_a_hot_group_goes_to_many_tasks(spark):
    df = spark.range(50_000).select(F.lit("g").alias("g"), F.format_string("%08d", F.col("id")).alias("v"))
    out = rank_within(df, ["g"], ["v"], parts=6)
    text = out._jdf.queryExecution().executedPlan().toString()
    # The window's groups are ranges of a group, never a whole one.
    assert "__span" in text and out.where("rank = 25000").first().v == "00024999"
    ranges = out.sparkSession.read.parquet(*{os.path.dirname(f) for f in out.inputFiles()})
    assert ranges.groupBy("__span").count().count() == 6


def test_no_stage_of_a_run_outgrows_generated_code():
    """Code beyond 64 KB is only logged, and the stage then runs without it."""
    script = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
              "from feedlake.session import build_session\n"
              "import __spark_entry__ as e\n"
              "s = build_session('local[4]', **{'spark.sql.shuffle.partitions': '4', 'spark.ui.showConsoleProgress': 'false'})\n"
              f"e.queries()['etl_after_failure'](s, {SF_SMALL!r}).write.format('noop').mode('overwrite').save()\n")
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, check=True)
    assert "64 KB" not in done.stderr and "64 KB" not in done.stdout


def test_a_days_rows_are_computed_once_and_their_ids_grouped_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    feed = spark.createDataFrame([("s", "a", "1"), ("s", "a", "2"), (None, None, "3"), ("s", None, None)],
                                 "source_name string, property_id string, price string")
    store = ProfileStore(spark, os.path.join(tmp_dir, "p"), ["property_id", "price"])
    store.add("one", feed.mapInArrow(counted, feed.schema))
    assert seen.value == 4
    assert rows(store.profile(["one"]).stats.select("source_name", "rows")) == {("s", 3)[::-1]: 1, (None, 1)[::-1]: 1}
    day = spark.read.parquet(os.path.join(tmp_dir, "p", "metrics", "day=one"))
    assert {(r.source_name, r.duplicate_ids) for r in day.collect()} == {("s", 1), (None, 0)}
    assert any("/ids/day=one" in f for f in store._metrics(feed, store.profile(["one"]).parts["ids"]).inputFiles())


def test_customers_meet_orders_before_line_items(spark):
    from feedlake.sources.wide_fixture import wide_feed

    plan = wide_feed(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(k for k, line in enumerate(plan) if "Join" in line and "c_custkey" in line)
    depth = plan[at].index("Join")
    below = [line for line in plan[at + 1:]]
    below = below[:next((k for k, line in enumerate(below) if len(line) - len(line.lstrip(" :+-")) <= depth), len(below))]
    assert below and not any("l_orderkey" in line for line in below)
