"""Parquet sinks (K1, K2), table registration (K3) and read-back (S3)."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import config as C
from feedlake.session import stored_copy

OVERWRITE_MODES = ("dynamic", "static")
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def write_feed(df: DataFrame, path: str, partition_by: Sequence[str] = ("feed_date",),
               overwrite: str = "dynamic", writers: int | None = None,
               max_records_per_file: int | None = None, deal: bool = True) -> None:
    """Write Parquet partitioned by ``partition_by``, replacing what it covers.

    ``overwrite='dynamic'`` replaces only the partitions present in ``df``
    (other dates under ``path`` survive: a rerun for one day is safe);
    ``'static'`` replaces everything under ``path``.

    Rows are dealt to ``writers`` tasks (default: the shuffle partitions) by
    range over the partition columns and then the id: neighbouring folders go
    to one writer, which writes one file for each, and a folder that holds a
    large share of the rows is split between several. ``deal=False`` if ``df`` is
    a plain read of rows stored by the same folders: each of its files is written
    to one folder by the task that reads it, without a shuffle.
    """
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"overwrite must be one of {OVERWRITE_MODES}")
    cols = list(partition_by)
    out = df
    if cols and deal:
        n = writers or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        within = [C.KEY_COL] if C.KEY_COL in df.columns and C.KEY_COL not in cols else []
        out = df.repartitionByRange(n, *cols, *within)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


def write_sources(df: DataFrame, path: str, overwrite: str = "dynamic", **kw) -> None:
    """K1 for every source in one job: ``{path}/source_name=<s>/feed_date=<d>/``."""
    write_feed(df, path, (C.SOURCE_COL, "feed_date"), overwrite=overwrite, **kw)


def write_combined(df: DataFrame, path: str, overwrite: str = "dynamic", **kw) -> None:
    """K2: the combined table, ``{path}/feed_date=<d>/source_name=<s>/``."""
    write_feed(df, path, ("feed_date", C.SOURCE_COL), overwrite=overwrite, **kw)


def string_partitions(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    """``schema`` with the partition columns typed as strings, placed last."""
    data = [f for f in schema.fields if f.name not in partition_by]
    return T.StructType(data + [T.StructField(c, T.StringType(), True) for c in partition_by])


def read_feed_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    partition_by: Sequence[str] = ("feed_date", C.SOURCE_COL)) -> DataFrame:
    """S3: read a partitioned feed table back.

    Partition discovery would type ``feed_date`` as a date (or flip it to
    text when one odd value is present); with ``schema`` the partition
    columns are read as the strings they were written as. Without a schema
    they are cast to string after discovery.
    """
    if schema is not None:
        return spark.read.schema(string_partitions(schema, partition_by)).parquet(path)
    df = spark.read.parquet(path)
    return df.withColumns({c: F.col(c).cast("string") for c in partition_by if c in df.columns})


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                   partition_by: Sequence[str] = ("feed_date", C.SOURCE_COL)) -> str:
    """K3: an external Parquet table over ``path`` with its partitions found.

    The table keeps the partition columns as strings (declared schema) and
    prunes on them. Returns the table name.
    """
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table name: {name!r}")
    full = string_partitions(schema, partition_by)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    location = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY ({parts}) "
              f"LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


PARTITIONS_PER_STATEMENT = 500  # named in one statement
STATEMENTS_AT_ONCE = 8
FOLDERS_PER_TASK = 64           # that one task deletes


def _sql_text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _alter_partitions(spark: SparkSession, name: str, folders: DataFrame, cols: Sequence[str],
                      change: str, between: str, location: str | None = None) -> int:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table name: {name!r}")
    def statements() -> Iterator[str]:
        # The names are streamed to the driver, a statement's worth at a time.
        names = [*cols, *([location] if location else [])]
        rows = folders.select(*names).distinct().toLocalIterator()
        while some := list(itertools.islice(rows, PARTITIONS_PER_STATEMENT)):
            specs = ["PARTITION (" + ", ".join(f"`{c}` = {_sql_text(r[c])}" for c in cols) + ")"
                     + (f" LOCATION {_sql_text(r[location])}" if location else "") for r in some]
            counts.append(len(some))
            yield f"ALTER TABLE {name} {change} {between.join(specs)}"

    counts: list[int] = []
    todo = statements()
    with ThreadPoolExecutor(STATEMENTS_AT_ONCE) as pool:
        while some := list(itertools.islice(todo, STATEMENTS_AT_ONCE)):
            list(pool.map(spark.sql, some))
    return sum(counts)


def add_table_partitions(spark: SparkSession, name: str, written: DataFrame,
                         partition_by: Sequence[str] = ("feed_date", C.SOURCE_COL), location: str | None = None) -> int:
    """K3 for an incremental run: register only the partitions just written.

    ``written`` is any frame with the partition columns; each of its distinct
    values, null included, is one partition. A full ``MSCK REPAIR TABLE`` would
    list every folder of the table on each run. ``location``: the column of ``written`` with a
    partition's folder, where that does not follow from the table's. Returns the number named.
    """
    return _alter_partitions(spark, name, written, list(partition_by), "ADD IF NOT EXISTS", " ", location)


def drop_table_partitions(spark: SparkSession, name: str, gone: DataFrame,
                          partition_by: Sequence[str] = ("feed_date", C.SOURCE_COL)) -> int:
    """K3 for an incremental run: forget partitions whose folders were removed."""
    return _alter_partitions(spark, name, gone, list(partition_by), "DROP IF EXISTS", ", ")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def folders_of(stored: DataFrame, chosen: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``folder``: the folders, by path, that hold rows of the Parquet read ``stored`` whose
    ``cols`` are among ``chosen``'s."""
    # The path is escaped like a URL's, in which a plus sign is itself; it is worked on once per file.
    path = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    files = stored_copy(stored.select(*cols, F.col("_metadata.file_path").alias("file")).distinct(), "files")
    held = files.select(*cols, F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("folder")).distinct()
    return held.join(chosen, same_folder(held, chosen, cols), "left_semi").select("folder").distinct()


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from feedlake.sources.heads import file_system

    for batch in batches:
        gone = []
        for folder in batch.column("folder").to_pylist():
            system, path = file_system(folder)
            there = system.get_file_info(path).type == fs.FileType.Directory
            if there:
                try:
                    system.delete_dir(path)
                except FileNotFoundError:  # an attempt before this one was as far
                    pass
            gone.append(int(there))
        yield pa.RecordBatch.from_arrays([pa.array(gone, pa.int64())], names=["gone"])


def remove_folders(spark: SparkSession, folders: DataFrame) -> int:
    """Delete the folders named in ``folders`` by a job on the executors; the number that were
    there. Only file systems that ``pyarrow`` does not know are left to the driver."""
    from feedlake.sources.heads import opens

    named = stored_copy(folders.select("folder").distinct(), "doomed")
    one = named.first()
    if one is None:
        return 0
    if opens(one["folder"]):
        tasks = -(-named.count() // FOLDERS_PER_TASK)
        return named.repartition(tasks).mapInArrow(_delete, "gone long").agg(F.sum("gone")).first()[0]
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for r in named.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(r["folder"])
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def same_folder(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> F.Column:
    """Join condition on partition columns, null folders included."""
    on = F.lit(True)
    for c in cols:
        on = on & a[c].eqNullSafe(b[c])
    return on


def rewrite_touched(processed: DataFrame, path: str, partition_by: Sequence[str],
                    keep: F.Column | None = None, keys: DataFrame | None = None,
                    once: bool = True) -> tuple[DataFrame, DataFrame]:
    """Bring the stored table under ``path`` up to date with ``processed`` around some ids.

    The ids are those of ``keys``, or those that ``processed`` or the table
    have in rows that pass ``keep``, or all of ``processed``. Every folder that
    holds one of them before or after, and every stored folder that passes
    ``keep``, is rewritten whole from ``processed``; a folder left without rows
    is removed. So an id whose surviving row moved to another date is stored
    once, as after a full load. Returns the folders written and those removed.
    ``processed`` is read several times and is stored first, so that it is computed
    once; ``once=False`` if it is a plain read of rows stored by the same folders.
    """
    spark, cols, ids = processed.sparkSession, list(partition_by), [C.KEY_COL, C.SOURCE_COL]
    narrow = list(dict.fromkeys([*ids, *cols]))
    processed = stored_copy(processed, "processed") if once else processed
    stored = read_feed_table(spark, path, processed.schema, cols)
    now = processed.select(*narrow)
    if keep is None and keys is None:
        # Each row of this run has one of its ids (a null is none); only the table's are looked up.
        named = now.where(F.col(C.KEY_COL).isNotNull() & F.col(C.SOURCE_COL).isNotNull())
        places = named.select(*cols).unionByName(stored.join(named.select(*ids), ids, "left_semi").select(*cols))
    else:
        if keys is None:
            keys = now.where(keep).select(*ids).unionByName(stored.where(keep).select(*ids))
        touched = keys.select(*ids).distinct()
        places = now.unionByName(stored.select(*narrow)).join(touched, ids, "left_semi").select(*cols)
        if keep is not None:
            places = places.unionByName(stored.where(keep).select(*cols))
    folders = stored_copy(places.distinct(), "folders")
    rows = processed.join(folders, same_folder(processed, folders, cols), "left_semi")
    written = stored_copy(rows.select(*cols).distinct(), "written")
    gone = stored_copy(folders.join(written, same_folder(folders, written, cols), "left_anti"), "gone")
    doomed = stored_copy(folders_of(stored, gone, cols), "doomed")
    write_feed(rows, path, cols, overwrite="dynamic", deal=once)
    remove_folders(spark, doomed)
    return written, gone


def write_source_folders(df: DataFrame, root: str, sources: Sequence[str],
                         overwrite: str = "dynamic") -> list[str]:
    """K1 in the one-folder-per-source layout: ``{root}/{source}/processed/``
    partitioned by ``feed_date``, for each source in ``sources``.

    One write per source (the list is the registry, not data). Pass the
    stored per-source table (partitioned by ``source_name``) so each write
    reads only its own partition folders. Returns the paths written.
    """
    base = root.rstrip("/")
    paths = []
    for s in dict.fromkeys(sources):
        path = f"{base}/{s}/processed"
        one = df.where(F.col(C.SOURCE_COL) == s)
        write_feed(one, path, ("feed_date",), overwrite=overwrite)
        paths.append(path)
    return paths
