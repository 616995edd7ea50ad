"""Operator 2, mixing sources to target weights: hash-threshold histograms.

Every document has a 60-bit hash of its id and text. A source's budget becomes a
threshold: the documents with a smaller hash are taken. Words are summed by
source and hash bucket, a running sum over the buckets finds the bucket where
the budget is met, and only that boundary bucket is summed again, more finely.
Nothing is sorted by hash; the mix is a filter on thresholds. Thresholds are
nested: a larger budget takes what a smaller one took. A budget above a
source's size takes all its documents and, below the threshold, a second copy.

Only DataFrame functions run here.

Defined cases: a null text has no words; null sources form one source, ordered
last; documents without words are taken zero words of; rows that repeat an id
and a text share a hash and are taken together; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import WORD, materialise, text_or_empty

LEVEL_BITS = (12, 12, 12, 12)  # buckets per refinement
WEIGHTS = (3, 1, 2)
SHARE = 1.5       # of all words
MAX_REPEATS = 2   # of a source
BROADCAST_SOURCES = 50_000  # above this many, per-source values are joined by a shuffle


def word_count(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Targets share ``share`` of all words by weight; a target above
    ``max_repeats`` times its source stops there and the excess goes to the
    others by weight. With sources ordered by cap per weight, the capped ones
    are a prefix: the first source whose cap covers its part of what the
    sources before it left ends the prefix.
    """
    by_code_point = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_code_point) - 1, F.lit(len(weights))) + 1).cast("int"))
    all_sources = Window.partitionBy()
    by_cap = Window.orderBy("ratio", F.col("source").isNull(), F.encode("source", "utf-8"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(all_sources) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(all_sources) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    return (sizes.withColumn("weight", weight)
                 .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
                 .withColumn("ratio", F.col("cap") / F.col("weight"))
                 .withColumn("level", left / rest)
                 .withColumn("open", F.when(F.col("ratio") >= F.col("level"),
                                            F.struct(F.row_number().over(by_cap).alias("at"), "level")))
                 # The level at the first source that isn't capped holds for all after it.
                 .withColumn("level", F.min("open").over(all_sources)["level"])
                 .withColumn("target", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))))
                 .select("source", "source_size", "target"))


def _bucket(level: int) -> Column:
    """The bits of the hash that ``level`` sums by."""
    below = sum(LEVEL_BITS[level + 1:])
    return F.shiftright("h", 60 - sum(LEVEL_BITS) + below).bitwiseAND((1 << LEVEL_BITS[level]) - 1)


def _prefix(level: int, h: str = "h") -> Column:
    """The hash without the bits that ``level`` and later levels sum by."""
    return F.shiftright(h, 60 - sum(LEVEL_BITS[:level]))


def _small(df: DataFrame, n_rows: int) -> DataFrame:
    """``df``, of one row per source, as the broadcast side while that is known to be small."""
    return F.broadcast(df) if n_rows <= BROADCAST_SOURCES else df


def thresholds(rows: DataFrame, targets: DataFrame, n_sources: int) -> DataFrame:
    """``source, copies, threshold``: take each document ``copies`` times, and
    once more if the first bits of its hash are below ``threshold``.

    ``rows``: ``source, size, h``.
    """
    copies = F.floor(F.col("target") / F.col("source_size"))
    state = (targets.withColumn("copies", F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0)))
                    .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
                    .withColumn("prefix", F.lit(0).cast("long"))
                    .select("source", "copies", "budget", "prefix"))
    per_source = Window.partitionBy("source").orderBy("bucket")
    for level in range(len(LEVEL_BITS)):
        state = state.select(F.col("source").alias("s"), "copies", "budget", "prefix")
        same = F.col("source").eqNullSafe(F.col("s")) & (_prefix(level) == F.col("prefix"))
        sums = (rows.join(_small(state.select("s", "prefix"), n_sources), same)
                    .groupBy("source", "prefix", _bucket(level).alias("bucket"))
                    .agg(F.sum("size").alias("n")))
        running = F.sum("n").over(per_source)
        width = 1 << LEVEL_BITS[level]
        # The boundary is the first bucket with which the sum passes the budget.
        sums = sums.withColumn("upto", running).select(F.col("source").alias("x"), "bucket", "n", "upto")
        state = state.join(sums, F.col("x").eqNullSafe(F.col("s")), "left")
        over = F.col("upto") > F.col("budget")
        first_over = F.struct("bucket", "n", "upto")
        picked = state.groupBy("s").agg(
            F.first("copies").alias("copies"), F.first("budget").alias("budget"), F.first("prefix").alias("prefix"),
            F.min(F.when(over, first_over)).alias("at"))
        before = F.col("at.upto") - F.col("at.n")
        # No bucket passes the budget: all of this prefix is below the threshold.
        state = picked.select(
            F.col("s").alias("source"), "copies",
            F.when(F.col("at").isNull(), F.lit(0.0)).otherwise(F.col("budget") - before).alias("budget"),
            (F.col("prefix") * width + F.coalesce(F.col("at.bucket"), F.lit(width))).alias("prefix"),
            F.col("at.n").alias("n"))
        last = state
        state = state.drop("n")
    # The last bucket is taken if that leaves the smaller difference.
    take = F.coalesce((F.col("n") - F.col("budget") < F.col("budget")).cast("long"), F.lit(0))
    return last.select("source", "copies", (F.col("prefix") + take).alias("threshold"))


def _hash() -> Column:
    """Of the id and the text: rows whose ids are null or shared can still be taken one by one."""
    return F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), text_or_empty()), 4)


def _limits(docs: DataFrame, weights: tuple[int, ...], share: float, max_repeats: int) -> tuple[DataFrame, DataFrame]:
    """Narrow rows ``doc_id, source, size, h`` and, per source ``s``, its size, target and thresholds."""
    rows = materialise(docs.select("doc_id", "source", word_count().alias("size"), _hash().alias("h")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, max_repeats), "mix-targets")
    n_sources = targets.count()
    limits = (targets.alias("t").join(thresholds(rows, targets, n_sources).alias("l"),
                                      F.col("t.source").eqNullSafe(F.col("l.source")))
                     .select(F.col("t.source").alias("s"), "source_size", "target", "copies", "threshold"))
    return rows, _small(materialise(limits, "mix-limits"), n_sources)


def _times(max_repeats: int, copies: str = "copies", threshold: str = "threshold", h: str = "h") -> Column:
    """How often the mix takes a document."""
    times = F.col(copies) + (_prefix(len(LEVEL_BITS), h) < F.col(threshold)).cast("int")
    return F.least(times, F.lit(max_repeats)).cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken`` of every row of ``docs``
    (``doc_id``, ``source``, ``text``)."""
    rows, limits = _limits(docs, weights, share, max_repeats)
    return (rows.join(limits, F.col("source").eqNullSafe(F.col("s")))
                .withColumn("times", _times(max_repeats))
                .select("doc_id", "source", "size", "source_size", "target", "times",
                        (F.col("size") * F.col("times")).alias("taken")))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them. Texts are not shuffled."""
    names = docs.columns
    _, limits = _limits(docs, weights, share, max_repeats)
    limits = limits.select(F.struct("copies", "threshold", F.col("s")).alias("__mix"))
    return (docs.withColumn("__h", _hash()).join(limits, F.col("source").eqNullSafe(F.col("__mix.s")))
                .withColumn("__times", _times(max_repeats, "__mix.copies", "__mix.threshold", "__h"))
                .where("__times > 0")
                .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*names))
