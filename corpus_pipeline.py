"""Corpus pipeline over ``documents``: quality rules, n-gram Jaccard join,
suffix-array dedup, mixing to target weights, best-fit packing.

Each stage takes all rows that the stage before kept, as reread from Parquet.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import mixing
from feedlake.llm.common import materialise, text_or_empty
from feedlake.llm.jaccard_join import jaccard_components
from feedlake.llm.packing import pack
from feedlake.llm.quality import quality_rules
from feedlake.llm.suffix_dedup import suffix_dedup

TOKENIZER = "byte_bpe_50k.json"


#: Names of the stages' own columns are put beside a document's as one column of a name that no
#: caller's column has.
OWN = "corpus pipeline"


def _own(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    name = OWN
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def text_key() -> Column:
    """Ids may be null or shared; with the hashes of its text a row is known for sure."""
    return F.struct(F.xxhash64(text_or_empty()).alias("k1"), F.xxhash64(F.lit(7), text_or_empty()).alias("k2"))


def _semi(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """``docs`` whose columns and text hashes are among the rows of ``chosen``, whose columns are
    named like ``docs``', or ``k1, k2`` for the hashes. Null equals null."""
    own = _own(docs)
    columns = [c for c in chosen.columns if c not in ("k1", "k2")]
    left = docs.withColumn(own, F.struct(text_key().alias("key"), *[F.col(f"`{c}`").alias(c) for c in columns]))
    right = chosen.select(F.struct(F.struct("k1", "k2").alias("key"), *columns).alias(own + "s"))
    on = F.lit(True)
    for field in ("key.k1", "key.k2", *columns):
        on = on & F.col(f"`{own}`.{field}").eqNullSafe(F.col(f"`{own}s`.{field}"))
    return left.join(right, on, how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are. A verdict holds for the rows of
    one text and source, whatever their ids."""
    rejected = (quality_rules(docs, with_key=True).where("NOT kept")
                .select(F.col("host").alias("source"), F.col("r1").alias("k1"), F.col("r2").alias("k2")).distinct())
    return _semi(docs, rejected, "left_anti").select(*_names(docs))


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id (a null id is the
    largest); of rows that repeat that id and text, one. Documents without words link with
    nothing and stay; of those that repeat an id and text, one."""
    rows = (jaccard_components(docs, with_key=True)
            .groupBy("component", "doc_id", F.col("r1").alias("k1"), F.col("r2").alias("k2"))
            .agg(F.count(F.lit(1)).alias("n")))
    rows = materialise(rows, "jaccard-ids")
    first = (rows.where("component IS NOT NULL").groupBy("component")
                 .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "n")).alias("x"))
                 .select("x.doc_id", "x.k1", "x.k2", "x.n"))
    kept = materialise(first.unionByName(rows.where("component IS NULL").drop("component")), "kept-ids")
    once, more = kept.where("n = 1").drop("n"), kept.where("n > 1").drop("n")
    own, names = _own(docs), _names(docs)
    # Of rows that repeat an id and a text, the first by what else they hold, so that a rerun keeps the same.
    ordered = [f"`{f.name}`" for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    single = (_semi(docs, more, "left_semi").groupBy(own)
              .agg(F.min_by(F.struct(*names), F.struct(*ordered)).alias(own + "r")).select(f"`{own}r`.*"))
    return _semi(docs, once, "left_semi").select(*names).unionByName(single)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that repeat across them. Characters of which a
    byte went go whole; documents of which nothing is left go."""
    own = _own(docs)
    cleaned = (suffix_dedup(docs, with_text=True).where("kept_text IS NOT NULL")
               .select(F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias(own), "kept_text")
               .dropDuplicates([own]).select(own, F.col("kept_text").alias(own + "t")))
    joined = docs.withColumn(own, text_key()).join(cleaned, own, "left")
    text = F.col(f"`{own}t`")
    left = joined.where(text.isNull() | (text != ""))
    return left.select(*[
        F.coalesce(text, F.col("text")).alias(c) if c == "text" else
        F.when(text.isNotNull(), F.char_length(text).cast("long")).otherwise(F.col("n_chars")).alias(c) if c == "n_chars" else
        F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixture(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return pack(docs, public_tokenizers.path(TOKENIZER)).drop("ids")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("mixing sources", mixture),
    ("best-fit packing", packed),
]

#: Shingle groups, suffix dedup and packing have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return docs
