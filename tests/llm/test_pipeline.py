"""The pipeline's stages on small tables, each against a plain version on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from feedlake.llm.common import connected_components
from feedlake.llm.registry import QUERIES

from .test_operators import corpus, optimum, plain_components, plain_quality, plain_suffix, table

__all__ = ["optimum"]


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_stages(spark):
    docs = table(spark, corpus(6, 40) + [(700 + k, " ".join(f"p{j}" for j in range(90)), "c") for k in range(5)])
    before, columns = rows_of(docs), docs.columns

    kept = corpus_pipeline.quality(spark, docs, "")
    rejected = {x[0] for x in plain_quality(before, 50, 0.2) if not x[-1]}
    assert kept.columns == columns
    rows = rows_of(kept)
    assert Counter(rows) == Counter(r for r in before if r[0] not in rejected) and rows

    one = corpus_pipeline.one_of_each_group(spark, kept, "")
    assert one.columns == columns
    left = rows_of(one)
    assert Counter(r[0] for r in left) == Counter({x[0] for x in plain_components(rows) if x[0] == x[2]})

    clean = corpus_pipeline.without_repeats(spark, one, "")
    assert clean.columns == columns
    removed = {x[0]: x[2] for x in plain_suffix(left)}
    texts, cleaned = {r[0]: r[1] for r in left}, {r[0]: r[1] for r in rows_of(clean)}
    assert any(removed.values())
    for i, n in removed.items():
        if not n:
            assert cleaned[i] == texts[i]
        elif i in cleaned:  # whole characters go
            assert n <= len(texts[i].encode()) - len(cleaned[i].encode()) <= n + 8 * 3
        else:
            assert n >= len(texts[i].encode()) - 8

    mixed = corpus_pipeline.mixture(spark, clean, "")
    assert mixed.columns == columns
    times = Counter(r[0] for r in rows_of(mixed))
    assert set(times.values()) <= {1, 2} and set(times) <= set(cleaned)
    assert {r[0]: r[1] for r in rows_of(mixed)}.items() <= cleaned.items()

    pieces = corpus_pipeline.packed(spark, mixed, "").collect()
    whole = Counter(p["doc_id"] for p in pieces if p["piece"] == 0)
    assert whole == times
    assert max(sum(p["length"] for p in pieces if p["sequence_id"] == s) for s in {p["sequence_id"] for p in pieces}) <= 1024


def test_run_and_names(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "best-fit packing"]
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, k) for k in range(6, 40)]
    out = connected_components(spark.createDataFrame([*chain, *star, (7, 7), (39, 6)], "u long, v long"))
    got = {r["node"]: r["component"] for r in out.collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(5, 40), 5)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_stages_with_null_and_shared_ids(spark):
    def words(name, n=60):
        return " ".join(f"{name}{j}" for j in range(n))
    passage = words("passage")
    rows = [(None, words("a"), "s"), (None, words("b"), "s"), (7, words("c"), "s"), (7, words("d"), "s"),
            (None, "too short", "s"), (7, "short too", "s"), (8, words("e"), "s"), (9, words("e") + " f", "s"),
            (8, words("e"), "s"), (None, words("g") + " " + passage, "s"), (None, words("h") + " " + passage, "s")]
    docs = table(spark, rows)
    kept = corpus_pipeline.quality(spark, docs, "")
    assert Counter(rows_of(kept)) == Counter(r for r in rows if "short" not in r[1])
    one = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert one.columns == docs.columns
    assert Counter(rows_of(one)) == Counter(r for r in dict.fromkeys(rows) if r[0] != 9)
    clean = Counter(rows_of(corpus_pipeline.without_repeats(spark, one, "")))
    assert sum(clean.values()) == sum(r[0] != 9 for r in dict.fromkeys(rows))
    assert all(sum(i is None and t.startswith(x) and "passage30" not in t for i, t, _ in clean) == 1 for x in ("g0 ", "h0 "))
    assert {r for r in dict.fromkeys(rows) if r[0] in (7, 8) or r[0] is None and r[1][0] in "abt"} <= set(clean)


def test_columns_of_the_stages_names(spark):
    """A caller's columns may be named like those the stages use, and stay as they are."""
    from pyspark.sql import functions as F

    docs = table(spark, corpus(6, 12) + [(800, " ".join(f"q{j}" for j in range(80)), "c")])
    names = ("k1", "k2", "r1", "r2", "component", "kept_text", "corpus pipeline", "corpus pipeline_", "__text", "id", "x y")
    extra = docs.select(*docs.columns, *[F.lit(c).alias(c) for c in names if c not in docs.columns])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, ""), stage(spark, extra, "")
        assert out.columns == extra.columns
        rows = out.collect()
        assert Counter(tuple(r[c] for c in docs.columns) for r in rows) == Counter(map(tuple, plain.collect())) and rows
        assert all(r[c] == c for r in rows for c in names if c not in docs.columns)
    assert corpus_pipeline.packed(spark, extra, "").count() == corpus_pipeline.packed(spark, docs, "").count()
