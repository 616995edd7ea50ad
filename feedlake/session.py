"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for. AQE re-plans shuffles at run
# time (coalescing small partitions, splitting skewed joins); the session time
# zone pins the ingestion timestamp text.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "feedlake",
                  **conf: str) -> SparkSession:
    """Get or create a session with the recommended settings.

    ``conf`` keys use underscores for dots, or pass full keys via a dict:
    ``build_session(**{"spark.sql.shuffle.partitions": "8"})``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` (HDFS, object store, shared mount) is used as is.
    Only a ``local`` session, as in tests, gets a folder of its own when that is
    unset; a cluster without a shared folder is an error, since its executors
    do not see each other's disks.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"master {sc.master} needs spark.checkpoint.dir, a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="feedlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "feedlake", f"{name}-{uuid.uuid4().hex[:12]}")


def stored_copy(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage is cut,
    several readers share one run, and the optimizer knows the size. ``compression``: other
    than the session's, for copies of a whole feed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
