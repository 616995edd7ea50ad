"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import read
from feedlake.llm.embedding_dedup import embedding_dedup
from feedlake.llm.html_extract import extract_text
from feedlake.llm.jaccard_join import jaccard_components
from feedlake.llm.mixing import mix
from feedlake.llm.packing import pack
from feedlake.llm.periodic_runs import periodic_runs
from feedlake.llm.quality import quality_rules
from feedlake.llm.quality_classifier import quality_scores
from feedlake.llm.sharding import shard_documents
from feedlake.llm.substring_dedup import substring_dedup
from feedlake.llm.suffix_dedup import suffix_dedup
from feedlake.llm.token_alignment import token_alignment
from feedlake.llm.token_counts import edited_token_counts, sample_edits

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"


def op1_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op6_quality_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).drop("ids")


def op9_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))


def op10_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return edited_token_counts(docs.withColumn("edits", sample_edits()), public_tokenizers.path(TOKENIZER))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                           public_tokenizers.path(OTHER_TOKENIZER))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shard_minimax": op1_shard_minimax,
    "op2_mix_sources": op2_mix_sources,
    "op3_embedding_neardup": op3_embedding_neardup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality_line_frequency": op6_quality_line_frequency,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_html_style_tree": op9_html_style_tree,
    "op10_edited_token_counts": op10_edited_token_counts,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {}
