"""The one-scan reader: headers by place, malformed rows, failures of single files."""

from __future__ import annotations

import gzip
import os
from collections import Counter

import pytest

from feedlake.operators import validate_feeds
from feedlake.sources import malformed_counts, quarantine, read_feed_scan
from feedlake.sources.heads import file_heads, first_line, hadoop_heads


def put(root, source, name, content):
    folder = os.path.join(root, source, "raw-data")
    os.makedirs(folder, exist_ok=True)
    data = content if isinstance(content, bytes) else content.encode()
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def rows(df, *cols):
    return sorted(tuple("" if r[c] is None else r[c] for c in cols) for r in df.collect())


def test_a_cell_that_reads_like_the_header_is_data(spark, tmp_dir):
    put(tmp_dir, "a", "f.csv", "property_id,price,address\nA1,5,property_id\nA2,6,x\n")
    feeds = read_feed_scan(spark, tmp_dir, ["a"])
    assert feeds.columns == {"a": ("property_id", "price", "address")} and not feeds.errors
    assert rows(feeds.df, "property_id", "price", "address") == [("A1", "5", "property_id"), ("A2", "6", "x")]


def test_a_repeated_header_line_is_a_row(spark, tmp_dir):
    put(tmp_dir, "a", "f.csv", "property_id,price\nA1,5\nproperty_id,price\nA2,6\n")
    put(tmp_dir, "a", "g.csv", "\n \n\nprice,property_id\r\n7,A3\r\nprice,property_id\r\n")
    feeds = read_feed_scan(spark, tmp_dir, ["a"])
    assert rows(feeds.df, "property_id", "price") == [("A1", "5"), ("A2", "6"), ("A3", "7"),
                                                      ("property_id", "price"), ("property_id", "price")]


def test_headers_with_quotes_marks_blanks_and_doubles(spark, tmp_dir):
    put(tmp_dir, "a", "f.csv", b'\xef\xbb\xbf"property_id", price ,"a,b",price,,PRICE\nA1,5,x,6,7,8\n')
    feeds = read_feed_scan(spark, tmp_dir, ["a"])
    assert feeds.columns["a"] == ("property_id", "price", "a,b", "PRICE")
    assert rows(feeds.df, "property_id", "price", "a,b") == [("A1", "5", "x")]
    assert malformed_counts(feeds.malformed).collect() == []


def test_malformed_rows_stay_and_are_quarantined(spark, tmp_dir):
    put(tmp_dir, "a", "f.csv", "property_id,price,address\nA1,5\nA2,6,x,more,y\nA3,7,z\nA4,,\n")
    put(tmp_dir, "b", "f.csv", "property_id,price\nB1,5\nB2\n")
    put(tmp_dir, "c", "f.csv", "property_id,price\nC1,\"5\"\n")
    feeds = read_feed_scan(spark, tmp_dir, ["a", "b", "c"])
    assert rows(feeds.df, "property_id", "price", "address") == [
        ("A1", "5", ""), ("A2", "6", "x"), ("A3", "7", "z"), ("A4", "", ""), ("B1", "5", ""), ("B2", "", ""), ("C1", "5", "")]
    # A query that reads one column judges rows alike.
    assert feeds.df.select("price").count() == 7
    kept = quarantine(feeds, os.path.join(tmp_dir, "quarantine"))
    assert rows(kept, "source_name", "line") == [("a", "A1,5"), ("a", "A2,6,x,more,y"), ("b", "B2")]
    assert rows(malformed_counts(kept), "source_name", "malformed_rows") == [("a", 2), ("b", 1)]
    assert all(r.feed_file.endswith("raw-data/f.csv") for r in kept.collect())


def test_each_file_is_scanned_once(spark, tmp_dir):
    put(tmp_dir, "a", "f.csv", "property_id,price\nA1,5\n")
    put(tmp_dir, "a", "g.csv", "price,property_id\n6,A2\n")
    put(tmp_dir, "b", "f.csv", "property_id,price\nB1,5\n")
    feeds = read_feed_scan(spark, tmp_dir, ["a", "b"])
    plan = feeds.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "FileScan text" not in plan   # one for each distinct header
    assert sorted(len(x.inputFiles()) for x in [feeds.df]) == [3]
    assert rows(feeds.df, "source_name", "property_id", "price") == [("a", "A1", "5"), ("a", "A2", "6"), ("b", "B1", "5")]


def test_one_bad_file_among_many_sources_reads_no_other_again(spark, tmp_dir, monkeypatch):
    names = [f"s{k}" for k in range(300)]
    for k, s in enumerate(names):
        put(tmp_dir, s, "f.csv", f"property_id,price\n{s}-1,{k}\n")
    put(tmp_dir, "s7", "g.csv.gz", b"not a gzip file")
    whole = gzip.compress(b"property_id,price\n" + b"".join(b"x%d,%d\n" % (i, i * i) for i in range(5000)))
    put(tmp_dir, "s8", "g.csv.gz", whole[:len(whole) // 2])              # ends too early
    put(tmp_dir, "s9", "g.csv.gz", gzip.compress(b"property_id,price\nz,1\n"))
    put(tmp_dir, "s10", "g.csv", "id,price\nz,1\n")
    put(tmp_dir, "s11", "listings.csv", "")                              # an empty stub beside a feed
    put(tmp_dir, "only-empty", "listings.csv", "\n")
    opened = Counter()
    monkeypatch.setattr("feedlake.sources.csv_feeds.file_heads",
                        lambda session, files: (opened.update(files), file_heads(session, files))[1])
    feeds = read_feed_scan(spark, tmp_dir, [*names, "only-empty", "missing"])
    assert max(opened.values()) == 1 and len(opened) == 305           # the empty stub has nothing to read
    assert set(feeds.errors) == {"s7", "s8", "s10", "only-empty", "missing"}
    assert "g.csv.gz" in feeds.errors["s7"] and "g.csv.gz" in feeds.errors["s8"]
    assert feeds.errors["s10"] == "a file has no header with property_id"
    assert feeds.errors["only-empty"] == "missing column property_id"
    assert feeds.heads.where("error IS NOT NULL").count() == 2
    got = Counter(r.source_name for r in feeds.df.collect())
    assert len(got) == 297 and got["s9"] == 2 and got["s11"] == 1
    status = {r.source_name: r.passed for r in validate_feeds(feeds.df, feeds.sources, feeds.errors).collect()}
    assert sum(status.values()) == 297 and not status["s8"]


def test_many_headers_and_columns_that_come_and_go(spark, tmp_dir):
    for k in range(12):
        put(tmp_dir, f"s{k}", "f.csv", f"property_id,own{k},price\nP{k},o{k},{k}\n")
    feeds = read_feed_scan(spark, tmp_dir, [f"s{k}" for k in range(12)])
    assert {r.source_name: (r.property_id, r.price, r[f"own{r.source_name[1:]}"]) for r in feeds.df.collect()} == {
        f"s{k}": (f"P{k}", str(k), f"o{k}") for k in range(12)}
    assert all(r["own3"] is None for r in feeds.df.collect() if r.source_name != "s3")


def test_odd_paths_and_no_sources(spark, tmp_dir):
    put(tmp_dir, "sp ace", "a file%20,x.csv", "property_id,price\nA,1\n")
    feeds = read_feed_scan(spark, tmp_dir, ["sp ace"])
    assert [r.property_id for r in feeds.df.collect()] == ["A"] and not feeds.errors
    none = read_feed_scan(spark, tmp_dir, ["nothing", "here"])
    assert none.df is None and set(none.errors) == {"nothing", "here"}


@pytest.mark.parametrize("content", [b"", b"\n\n", b"a,b", b"\r\n  \r\n\"a,1\",b\r\nx,y", b"x" * 200_000 + b",y\nz,1",
                                     b"\n" * 70_000 + b"a\n", "é,b\n1,2\n".encode(), b"a\rb\r"])
def test_executors_and_hadoop_find_the_same_first_line(spark, tmp_dir, content):
    path = os.path.join(tmp_dir, "f.csv")
    with open(path, "wb") as f:
        f.write(content)
    (mine,) = file_heads(spark, [path]).collect()
    ((_, names, error),) = hadoop_heads(spark, ["file://" + path])
    assert mine.error is None and error is None and mine.header == names


def test_first_line_reads_no_more_than_it_needs():
    class Stream:
        def __init__(self):
            self.left, self.reads = 100, 0

        def read(self, n):
            self.reads += 1
            self.left -= 1
            return b"a,b\nc" if self.left else b""
    stream = Stream()
    assert first_line(stream, False) == "a,b" and stream.reads == 1
    assert first_line(stream, True) == "a,b" and stream.reads == 100
