"""A partitioned Parquet table whose changes are published in one switch.

Under the root, ``data/run=<n>/...`` holds the folders that run n wrote, and
``versions/version=<n>/`` lists the folders that are the table as of run n (one row
per folder: the partition values, and the path below the root). A run first
writes its data, where no reader looks, and then its list. Spark's
commit puts ``_SUCCESS`` into a list last, and the newest list that has it is the
table: readers see the version before or the version after, never both or a part.
A run that stops anywhere before that leaves the old version, and the same run
can be repeated. Folders that no list names are removed later (``vacuum``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import config as C
from feedlake.session import stored_copy
from feedlake.sinks.parquet import (
    _IDENT,
    FOLDERS_PER_TASK,
    add_table_partitions,
    path_exists,
    remove_folders,
    same_folder,
    string_partitions,
    write_feed,
)

LAYOUT = ("feed_date", C.SOURCE_COL)


def _data(root: str) -> str:
    return f"{root.rstrip('/')}/data"


def _versions(root: str) -> str:
    return f"{root.rstrip('/')}/versions"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` came to its end."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def current_version(spark: SparkSession, root: str) -> int | None:
    """The newest version that was published, None before the first."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{_versions(root)}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    numbers = [int(s.getPath().getParent().getName().split("=")[1]) for s in found or []]
    return max(numbers, default=None)


def list_schema(layout: Sequence[str] = LAYOUT) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*layout, "folder")])


def folders(spark: SparkSession, root: str, version: int | None = None, layout: Sequence[str] = LAYOUT) -> DataFrame:
    """The folders of a version (the current one): the partition values and ``folder``, below the root."""
    version = current_version(spark, root) if version is None else version
    if version is None:
        return spark.createDataFrame([], list_schema(layout))
    return spark.read.schema(list_schema(layout)).parquet(f"{_versions(root)}/version={version}")


def read_folders(spark: SparkSession, root: str, chosen: DataFrame, schema: T.StructType,
                 layout: Sequence[str] = LAYOUT) -> DataFrame:
    """The rows of the folders in ``chosen``; no other folder is listed or read. Their names are
    metadata, which Spark's file index holds in the driver as well."""
    base = root.rstrip("/")
    paths = sorted(f"{base}/{r['folder']}" for r in chosen.select("folder").toLocalIterator())
    full = string_partitions(schema, layout)
    if not paths:
        return spark.createDataFrame([], full).select(*schema.names)
    # Spark lists many paths by a job of up to 10,000 tasks, one path or two in each.
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), -(-len(paths) // FOLDERS_PER_TASK))))
    try:
        read = spark.read.schema(full).option("basePath", f"{base}/data").parquet(*[_escape_glob(p) for p in paths])
    finally:
        spark.conf.set(key, before)
    return read.select(*schema.names)


def _escape_glob(path: str) -> str:
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def read_version(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None,
                 layout: Sequence[str] = LAYOUT) -> DataFrame:
    """The table as of a version (the current one)."""
    return read_folders(spark, root, folders(spark, root, version, layout), schema, layout)


def write_run(rows: DataFrame, root: str, run: int, layout: Sequence[str] = LAYOUT) -> DataFrame:
    """Write rows where only the lists of this and later runs can name them. Returns the folders
    written; a repeated run replaces what it wrote before."""
    path = f"{_data(root)}/run={run}"
    write_feed(rows, path, layout, overwrite="static")
    return written_folders(rows.sparkSession, root, run, rows.schema, layout)


def written_folders(spark: SparkSession, root: str, run: int, schema: T.StructType,
                    layout: Sequence[str] = LAYOUT) -> DataFrame:
    path = f"{_data(root)}/run={run}"
    folder = F.regexp_extract(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), rf"/(data/run={run}/.*)/[^/]*$", 1)
    # The path is worked on once per file, not once per row (of two distincts in one plan the first would be left out).
    files = spark.read.schema(string_partitions(schema, layout)).parquet(path)
    files = stored_copy(files.select(*layout, F.col("_metadata.file_path").alias("file")).distinct(), "files")
    return files.select(*layout, folder.alias("folder")).distinct()


def publish(root: str, version: int, live: DataFrame) -> None:
    """Make ``live`` (partition values and ``folder``) the table: the one switch."""
    before = current_version(live.sparkSession, root)
    if before is not None and before >= version:
        raise ValueError(f"version {version} is not after {before}, the current one")
    live.select(*live.columns).write.mode("overwrite").parquet(f"{_versions(root)}/version={version}")


def replace_folders(spark: SparkSession, root: str, version: int, rows: DataFrame, touched: DataFrame,
                    gone: DataFrame | None = None, layout: Sequence[str] = LAYOUT) -> None:
    """Publish a version in which the folders ``touched`` (partition values) hold ``rows`` and nothing
    else, those of ``gone`` are left out, and the others are as they were."""
    old = stored_copy(folders(spark, root, layout=layout), "folders-before")
    fresh = write_run(rows, root, version, layout)
    out = touched.select(*layout) if gone is None else touched.select(*layout).unionByName(gone.select(*layout))
    out = out.distinct()
    kept = old.join(out, same_folder(old, out, layout), "left_anti")
    publish(root, version, kept.unionByName(fresh))


def _table_of(name: str, version: int) -> str:
    return f"{name}__v{version}"


def register_version(spark: SparkSession, name: str, root: str, schema: T.StructType,
                     layout: Sequence[str] = LAYOUT) -> int | None:
    """K3: make ``name`` the current version for SQL, in one switch. Returns the version.

    Each version is an external table of its own, whose partitions lie where the
    version's list says, named in batches. ``name`` is a view on one of them, and
    replacing the view is the switch; a stop before it leaves the version before.
    Tables of versions before the one that the view had are then dropped.
    """
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table name: {name!r}")
    version = current_version(spark, root)
    if version is None:
        return None
    table = _table_of(name, version)
    full = string_partitions(schema, layout)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    location = f"{_data(root)}".replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # of a registration that stopped
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in layout)}) "
              f"LOCATION '{location}'")
    base = root.rstrip("/") + "/"
    add_table_partitions(spark, table, folders(spark, root, version, layout)
                         .withColumn("location", F.concat(F.lit(base), "folder")), layout, "location")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in schema.names)} FROM {table}")
    head, _, own = name.rpartition(".")
    listed = spark.sql(f"SHOW TABLES {f'IN {head} ' if head else ''}LIKE '{own}__v*'")
    for r in listed.toLocalIterator():
        number = r["tableName"].removeprefix(f"{own}__v".lower())
        if number.isdigit() and int(number) < version - 1:
            spark.sql(f"DROP TABLE IF EXISTS {_table_of(name, int(number))}")
    return version


def vacuum(spark: SparkSession, root: str, keep_versions: int = 1, layout: Sequence[str] = LAYOUT) -> int:
    """Remove data folders that none of the last ``keep_versions`` versions names, by a job on the
    executors. Data of a run after the current version is left alone: it may be in the making."""
    current = current_version(spark, root)
    if current is None:
        return 0
    base = root.rstrip("/")
    kept = [v for v in range(max(0, current - keep_versions + 1), current + 1)
            if is_written(spark, f"{_versions(root)}/version={v}")]
    named = folders(spark, root, kept[0], layout)
    for v in kept[1:]:
        named = named.unionByName(folders(spark, root, v, layout))
    folder = F.regexp_extract("path", r"/(data/run=\d+/.*)/[^/]*$", 1)
    stored = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(_data(root)).select(folder.alias("folder")).distinct()
              .withColumn("run", F.regexp_extract("folder", r"^data/run=(\d+)/", 1).cast("long")))
    dead = stored.where(F.col("run") <= current).join(named.select("folder").distinct(), "folder", "left_anti")
    return remove_folders(spark, dead.select(F.concat(F.lit(base + "/"), "folder").alias("folder")))
