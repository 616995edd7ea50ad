"""Operator 6, quality rules: cross-document line frequency.

Lines are normalised (lower case, runs of white space as one space, trimmed)
and hashed. For each host the distinct documents of each line are counted;
equal texts are one document, so copies of a good page do not count against
it. A line in more than ``max_documents`` documents of a host, and in more than
``max_share`` of them, is boilerplate there and is removed. A document that
keeps less than ``min_kept`` of its words is depleted and rejected, and so is
one that fails the base rules.

Near copies are one document as well. Documents that such a count would deplete
share nearly all their words with others. They are either near copies of one
page or pages of one template, and the places of their own words tell which. A
near copy's own words stand in place of lines that most of its group hold and it
lacks; a template page holds the template whole and adds its own words to it. If
at least half of a group's texts look like near copies, the group counts as one
document when the lines are counted again, else each of its texts counts. So a
line is boilerplate if documents of different content hold it, pages of one
template are rejected, and a page's near copies do not remove it.

Only DataFrame functions run here. A document's words stay in its row; what is
shuffled is one hash per distinct line, summed before the shuffle, so a line or
host that a third of all documents share costs each task one row.

Defined cases: a null text has no lines and no words and fails the base rules;
a null host is a host; repeated rows are rows of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import SPACE_CLASS, WORD, materialise, text_or_empty

MAX_DOCUMENTS = 50   # of a host that may share a line
MAX_SHARE = 0.001    # part of a host's documents that may, if that is more
MIN_KEPT = 0.2       # part of a document's words that must remain
MIN_WORDS = 50
MAX_REPEATED = 50    # percent of words in repeated windows
WINDOW = 3
SYMBOLS = r"[#*$%&|<>]"
_WORDS_BITS = 20
_WORDS_MASK = (1 << _WORDS_BITS) - 1


def split_words(text: Column) -> Column:
    trimmed = F.regexp_replace(text, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def normalised(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(line, f"{SPACE_CLASS}+", " "), "^ | $", ""))


def line_entries(text: Column) -> Column:
    """``h, words`` of every line that has a word."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return F.transform(lines, lambda x: F.struct(F.xxhash64(normalised(x)).alias("h"),
                                                 F.regexp_count(x, F.lit(WORD)).alias("words")))


def base_measures(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs``' ``keep`` columns, ``r1`` (hash of the text), ``lines`` and the base measures."""
    text = text_or_empty()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    rows = docs.select(
        *keep, F.xxhash64(text).alias("r1"), line_entries(text).alias("lines"),
        F.char_length(F.regexp_replace(text, f"{SPACE_CLASS}+", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, SYMBOLS.replace("[", "[^") + "+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.transform(split_words(text), lambda w: F.xxhash64(w)).alias("w"))
    rows = rows.withColumn("n_words", F.size("w").cast("long"))
    # Windows by hash and place; equal hashes are neighbours after the sort.
    windows = F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    rows = rows.withColumn("z", F.sort_array(windows))
    again = F.filter("z", lambda e, j: F.coalesce(e["h"] == F.get("z", j - 1)["h"], F.lit(False))
                     | F.coalesce(e["h"] == F.get("z", j + 1)["h"], F.lit(False)))
    rows = rows.withColumn("at", F.sort_array(F.transform(again, lambda e: e["i"])))
    steps = F.zip_with("at", F.slice("at", 2, F.size("at") + 1),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    repeated = F.aggregate(steps, F.lit(0), lambda total, x: total + x).cast("long")
    return rows.withColumn("n_repeat_words", repeated).drop("w", "z", "at")


def _common(counted: DataFrame, sizes: DataFrame, max_documents: int, max_share: float) -> DataFrame:
    """``f, g`` (host and hash) of lines over the limit. ``counted``: ``host, h`` and a document, distinct."""
    counts = counted.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_documents)
    return (counts.join(sizes, counts["host"].eqNullSafe(sizes["s"])).where(F.col("n") > max_share * F.col("documents"))
                  .select(F.col("host").alias("f"), F.col("h").alias("g")))


def _held(entries: DataFrame, lines: DataFrame) -> DataFrame:
    return entries.join(lines, F.col("host").eqNullSafe(F.col("f")) & (F.col("h") == F.col("g")), "left_semi")


def _words_of(keys: Column) -> Column:
    """Words of all lines of an array of line keys."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda n, x: n + x.bitwiseAND(F.lit(_WORDS_MASK)))


def near_copies(texts: DataFrame) -> DataFrame:
    """``host, r1, page`` of the texts that are near copies of one page. ``texts``: distinct
    ``host, r1`` with ``own`` (words outside shared lines) and ``keys`` (shared lines).

    Texts with the same smallest shared line are a group. Its core are the lines that at least half
    of it hold, so twice the lines of its texts at most. Texts that lack just that smallest line
    form groups of their own: a group goes to the largest one that has its line in the core.
    """
    texts = texts.withColumn("least", F.array_min("keys"))
    members = texts.groupBy("least").agg(F.count(F.lit(1)).alias("members"))
    core = materialise(
        texts.select("least", F.explode("keys").alias("key")).groupBy("least", "key").agg(F.count(F.lit(1)).alias("n"))
             .join(members, "least").where("2 * n >= members").select("least", "key", "members"), "quality-cores")
    page = core.groupBy(F.col("key").alias("least")).agg(F.max(F.struct("members", "least")).alias("x"))
    cores = core.groupBy(F.col("least").alias("page")).agg(F.collect_list("key").alias("core"))
    missing = _words_of(F.array_except("core", "keys"))
    judged = materialise(
        texts.join(page.select("least", F.col("x.least").alias("page")), "least").join(cores, "page")
             .select("host", "r1", "page", (F.col("own") <= 2 * missing).alias("near")), "quality-near")
    pages = judged.groupBy("page").agg(F.avg(F.col("near").cast("int")).alias("share")).where("share >= 0.5")
    return judged.join(pages, "page", "left_semi").select("host", "r1", "page")


def frequent_lines(rows: DataFrame, max_documents: int, max_share: float, min_kept: float) -> tuple[DataFrame, DataFrame]:
    """``f, g``: host and hash of the lines that are boilerplate, and the occurrences (``row, host,
    h, words``) of all that may be. ``rows``: ``row, host, r1, n_words, lines``."""
    sizes = materialise(rows.select("host", "r1").distinct().groupBy(F.col("host").alias("s"))
                            .agg(F.count(F.lit(1)).alias("documents")), "quality-hosts")
    counted = rows.select("host", "r1", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    first = materialise(_common(counted.distinct(), sizes, max_documents, max_share), "quality-lines")
    entries = (rows.select("row", "host", "r1", "n_words", F.explode("lines").alias("line"))
                   .select("row", "host", "r1", "n_words", "line.h", "line.words"))
    held = materialise(
        _held(entries, first).groupBy("row", "host", "r1", "n_words")
        .agg(F.sum("words").alias("shared"), F.collect_list(F.struct("h", "words")).alias("lines")), "quality-shared")
    # A line's key holds its number of words in the last bits.
    keys = F.transform("lines", lambda x: F.shiftleft(F.xxhash64("host", x["h"]), _WORDS_BITS)
                       .bitwiseOR(F.least(x["words"], F.lit(_WORDS_MASK)).cast("long")))
    own = F.col("n_words") - F.col("shared")
    texts = materialise(
        held.dropDuplicates(["host", "r1"]).select(
            "host", "r1", own.alias("own"), (own < min_kept * F.col("n_words")).alias("depleted"),
            F.array_distinct(keys).alias("keys"), F.array_distinct(F.transform("lines", lambda x: x["h"])).alias("hs")),
        "quality-texts")
    copies = near_copies(texts.where("depleted")).select(F.col("host").alias("f"), F.col("r1").alias("g"), "page")
    again = (texts.join(copies, F.col("host").eqNullSafe(F.col("f")) & (F.col("r1") == F.col("g")), "left")
                  .select("host", F.col("page").isNotNull().alias("copy"), F.coalesce("page", "r1").alias("document"),
                          F.explode("hs").alias("h")).distinct())
    lines = materialise(_common(again, sizes, max_documents, max_share), "quality-boilerplate")
    return lines, held.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.h", "line.words")


def quality_rules(docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS,
                  min_kept: float = MIN_KEPT, max_share: float = MAX_SHARE, with_key: bool = False) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``removed_words`` and ``kept`` of every
    row of ``docs`` (``doc_id``, ``text``, host). ``with_key`` adds ``host, r1, r2``, the hashes
    of the text; rows that agree in them have one verdict."""
    extra = ["r2"] if with_key else []
    base = base_measures(docs.select("doc_id", F.col(host).alias("host"), "text",
                                     F.xxhash64(F.lit(7), text_or_empty()).alias("r2")), "doc_id", "host", *extra)
    rows = materialise(base.withColumn("row", F.monotonically_increasing_id()), "quality-rows")
    frequent, held = frequent_lines(rows, max_documents, max_share, min_kept)
    removed = _held(held, frequent).groupBy("row").agg(F.sum("words").alias("removed_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = F.col("n_words") - F.col("removed_words") < min_kept * F.col("n_words")
    return (rows.drop("lines", *([] if with_key else ["r1", "host"])).join(removed, "row", "left").drop("row")
                .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
                .withColumn("base_failed", failed)
                .withColumn("kept", ~failed & ~depleted))


def without_frequent_lines(docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS,
                           min_kept: float = MIN_KEPT, max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` with its texts' frequent lines removed; hot hosts' lists are joined by host once."""
    rows = docs.select(F.col(host).alias("host"), F.xxhash64(text_or_empty()).alias("r1"),
                       line_entries(text_or_empty()).alias("lines"))
    rows = materialise(
        rows.withColumn("n_words", F.aggregate("lines", F.lit(0), lambda n, x: n + x["words"]).cast("long"))
            .withColumn("row", F.monotonically_increasing_id()), "quality-rows")
    own = "frequent lines"
    while own.lower() in (c.lower() for c in docs.columns):
        own += "_"
    lists = (frequent_lines(rows, max_documents, max_share, min_kept)[0].groupBy("f")
             .agg(F.collect_set("g").alias("g")).select(F.struct("f", "g").alias(own)))
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.coalesce(
        F.array_contains(F.col(f"`{own}`.g"), F.xxhash64(normalised(x))), F.lit(False)))
    return (docs.join(lists, F.col(f"`{host}`").eqNullSafe(F.col(f"`{own}`.f")), "left")
                .withColumn("text", F.array_join(kept, "\n")).drop(own))
