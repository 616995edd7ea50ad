"""Command line: the two batch jobs and the published query.

    python -m feedlake profile ROOT [--sources a,b] [--report OUT] [--extended-dates]
    python -m feedlake etl ROOT OUT [--sources a,b] [--dates d1,d2] [--table NAME] [--min-score S]
    python -m feedlake load ROOT STORE [--sources a,b] [--table NAME] [--batch N]
    python -m feedlake q1 COMBINED_PATH

``ROOT`` holds ``{source}/raw-data/*.csv``. ``profile`` shows the scores and
the overall grade and, with ``--report``, stores every report frame as
Parquet under that folder. ``etl`` validates, cleans, deduplicates, enriches
and stores the passing sources, builds the combined table and shows the run
summary and Q1. ``load`` adds the feeds under ROOT, those of a new day, to a
store whose cost per day follows that day's rows. Spark settings come from ``spark-submit`` / the environment.
"""

from __future__ import annotations

import argparse
import os
import sys

from feedlake import config as C


def _sources(text: str | None) -> list[str]:
    return [s for s in (text or "").split(",") if s] or list(C.DEFAULT_SOURCES)


def _print(df) -> None:
    """Every row as tab-separated text, streamed."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def _load(spark, args) -> int:
    from feedlake.plans.store_run import run_store
    from feedlake.sources import read_feed_root
    from feedlake.streaming.store import FeedStore

    feeds = read_feed_root(spark, args.root, _sources(args.sources))
    result = run_store(feeds, FeedStore(spark, args.store), args.batch, table=args.table, input_version=args.root)
    _print(result.summary.orderBy(C.SOURCE_COL))
    _print(result.counts)
    _print(result.totals)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="feedlake")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("profile", help="profile and score every source")
    p.add_argument("root")
    p.add_argument("--sources")
    p.add_argument("--report", help="folder for the report frames (Parquet)")
    p.add_argument("--strict-header", action="store_true")
    p.add_argument("--extended-dates", action="store_true", help="also label DD-MM-YYYY")
    e = sub.add_parser("etl", help="validate, clean, dedupe, enrich, store, combine")
    e.add_argument("root")
    e.add_argument("out")
    e.add_argument("--sources")
    e.add_argument("--dates", help="comma list of clean feed dates to (re)load")
    e.add_argument("--table", help="register the combined output under this name")
    e.add_argument("--strict-header", action="store_true")
    e.add_argument("--min-score", type=float, help="leave out sources scoring below this")
    d = sub.add_parser("load", help="add new feeds to a store")
    d.add_argument("root")
    d.add_argument("store")
    d.add_argument("--sources")
    d.add_argument("--table", help="point this name to the new version")
    d.add_argument("--batch", type=int, help="number of the batch, to repeat one that stopped")
    q = sub.add_parser("q1", help="rows per source and day of a combined table")
    q.add_argument("combined")
    args = parser.parse_args(argv)

    from feedlake.plans.pipeline import profile, q1_counts, run_etl
    from feedlake.session import build_session
    from feedlake.sources import read_feed_root

    spark = build_session()
    if args.command == "q1":
        _print(q1_counts(spark, args.combined))
        return 0
    if args.command == "load":
        return _load(spark, args)
    feeds = read_feed_root(spark, args.root, _sources(args.sources), strict_header=args.strict_header)
    if feeds.df is None:
        print(f"no readable source: {feeds.errors}", file=sys.stderr)
        return 1
    if args.command == "profile":
        report = profile(feeds.df, feeds.columns, feeds.errors, extended_dates=args.extended_dates)
        _print(report.scores.orderBy(C.SOURCE_COL))
        _print(report.overall)
        if args.report:
            frames = {"metrics": report.metrics, "stats": report.stats, "schema": report.schema,
                      "duplicates": report.duplicates, "numeric": report.numeric,
                      "dates": report.dates, "nulls": report.nulls,
                      "categories": report.categories, "scores": report.scores,
                      "overall": report.overall}
            for name, frame in frames.items():
                frame.write.mode("overwrite").parquet(os.path.join(args.report, name))
        return 0
    dates = [d for d in (args.dates or "").split(",") if d] or None
    result = run_etl(feeds.df, args.out, sources=feeds.sources, errors=feeds.errors,
                     dates=dates, table=args.table, min_score=args.min_score,
                     columns_by_source=feeds.columns)
    _print(result.summary.orderBy(C.SOURCE_COL))
    if result.counts is not None:
        _print(result.counts)
    if result.totals is not None:
        _print(result.totals)
    return 0


if __name__ == "__main__":
    sys.exit(main())
