"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import _rows

from .conftest import SF_SMALL

from feedlake.plans.registry import QUERIES
from feedlake.plans.wide_registry import WIDE_QUERIES

FEED_QUERIES = sorted({**QUERIES, **WIDE_QUERIES})


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "supplier", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    """Of the feed queries; those of training data are tested in ``tests/llm``."""
    assert set(FEED_QUERIES) <= set(entry.queries()) and set(FEED_QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["source_name", "feed_date", "rows"]
    assert df.count() > 0


@pytest.mark.parametrize("name", FEED_QUERIES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, cur.fetchall())


def test_a_changed_threshold_turns_a_row_red(spark, duck, monkeypatch):
    """The wide oracles share no values with ``config``."""
    from feedlake import config as C
    monkeypatch.setattr(C, "GRADES", ((90, "EXCELLENT"), (76, "GOOD"), (60, "FAIR")))
    df = entry.queries()["wide_quality_score"](spark, SF_SMALL)
    cur = duck.execute(entry.oracle_sql()["wide_quality_score"])
    d_cols = [d[0] for d in cur.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) != _rows(d_cols, cur.fetchall())


def test_wide_scores_reach_every_grade(spark):
    rows = {r.source_name: (r.score, r.grade) for r in entry.queries()["wide_quality_score"](spark, SF_SMALL).collect()}
    assert {g for _, g in rows.values()} == {"EXCELLENT", "GOOD", "FAIR", "POOR", "ERROR"}
    assert rows["w4"] == (75, "GOOD")


@pytest.mark.parametrize("name", ["validate_feeds", "clean_listings", "numeric_profile",
                                  "feed_counts_by_source_date", "quality_score"])
def test_query_matches_oracle_without_ansi(ansi_spark, duck, name):
    df = entry.queries()[name](ansi_spark, SF_SMALL)
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, cur.fetchall())
