"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.session import ensure_checkpoint_dir

# A word is a run of characters other than ASCII white space; the same set of
# characters that ``bytes.split()`` splits at.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what is
    above, and several readers share one run.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def arrow_schema(ddl: str) -> pa.Schema:
    """``"doc_id long, data binary"`` as an Arrow schema."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(),
             "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(","))])


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``(node, component)`` of undirected edges ``(u, v)``; component is the
    smallest node reachable. Nodes without an edge are not returned.

    Alternating large-star and small-star rounds: each round keeps at most as
    many edges as it got and their ends move towards the smallest node of the
    component, so a long chain needs a logarithmic number of rounds. Minima are
    partial aggregates; the joins back are split by AQE for a hot node.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, state = materialise(edges.distinct(), name), None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m")
                      .select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(down.select("u", F.col("m").alias("v")))
                      .where("u <> v")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct())
        current = materialise(small, name)
        # A star forest is the fixed point; its sums then repeat.
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == state:
            break
        state = (row[0], row[1])
    return (current.groupBy("u").agg(F.min("v").alias("component"))
            .select(F.col("u").alias("node"), "component")
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
