"""Daily incremental load (I1): batch by feed dates, or as a file stream.

Batch form: process the raw feed as a full run would (the dedupe still sees
every row of a source) and bring the stored table up to date around the ids
that have a row on the requested dates (see ``sinks.rewrite_touched``). Other
folders on disk are left alone.

Stream form: Structured Streaming over the raw feed folders with the
``availableNow`` trigger. The stream checkpoint records which files were
processed (the job's bookmark), so each run reads only new daily files. A
micro-batch first adds its raw rows to a history table, one folder per batch,
then processes the history of its sources as a full run would and rewrites
the folders that its ids touch. The table equals a full load of all files
seen. Each batch also records the validation of its sources; one that fails
is taken out of the table, and its rows stay in the history. A replayed batch
overwrites its own history and status folders and gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedlake import config as C
from feedlake.operators import validate_feeds
from feedlake.session import stored_copy
from feedlake.sinks import path_exists, read_feed_table, rewrite_touched, write_combined


def date_filter(dates: Sequence[str] | F.Column | None) -> F.Column | None:
    """``feed_date`` in a list of dates, or any predicate on the clean row."""
    if dates is None or isinstance(dates, F.Column):
        return dates
    return F.col("feed_date").isin(list(dates))


def incremental_load(raw: DataFrame, path: str, ingestion_timestamp: str | None = None,
                     dates: Sequence[str] | F.Column | None = None,
                     validation: DataFrame | None = None,
                     sources: Sequence[str] | None = None) -> DataFrame:
    """Process ``raw`` into the combined layout under ``path``.

    Without ``dates`` (a list of clean ``feed_date`` values or a predicate) it
    is a full load that replaces the table. With them, the folders that hold an
    id with a row on those dates are rewritten. Returns the validation frame of
    the run.
    """
    from feedlake.plans.pipeline import process

    spark = raw.sparkSession
    if validation is None:
        validation = stored_copy(validate_feeds(raw, sources), "validation")
    processed = process(raw, validation, ingestion_timestamp)
    keep = date_filter(dates)
    if keep is None or not path_exists(spark, path):
        write_combined(processed if keep is None else processed.where(keep), path, overwrite="static")
    else:
        rewrite_touched(processed, path, ("feed_date", C.SOURCE_COL), keep)
    return validation


def raw_feed_schema(columns: Sequence[str] = C.EXPECTED_COLUMNS) -> T.StructType:
    """All-text schema of a raw feed file, in file order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def source_from_path(root: str) -> F.Column:
    """Source slug from a file path laid out as ``{root}/{source}/raw-data/...``."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/raw-data/[^/]*$", 1)


def start_feed_stream(spark: SparkSession, root: str, out_path: str, checkpoint: str,
                      schema: T.StructType | None = None,
                      ingestion_timestamp: str | None = None,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Process all new feed files under ``{root}/*/raw-data/`` once
    (``availableNow``) and stop. Wait with ``.awaitTermination()``.

    The table is at ``out_path``, the raw history and the status of each
    batch's sources beside it at ``{out_path}-history`` and ``{out_path}-status``.
    Headers are checked against ``schema`` (``enforceSchema=false``), so a file
    whose columns are in another order fails instead of being read by
    position.
    """
    from feedlake.plans.pipeline import process

    reader = (spark.readStream.schema(schema or raw_feed_schema())
              .option("header", "true").option("enforceSchema", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.csv(f"{root.rstrip('/')}/*/raw-data/")
    stream = stream.withColumn(C.SOURCE_COL, source_from_path(root))
    base = out_path.rstrip("/")
    history, status = f"{base}-history", f"{base}-status"

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
        seen = session.read.schema(batch.schema).option("basePath", history).parquet(f"{history}/batch_id={batch_id}")
        names = stored_copy(seen.select(C.SOURCE_COL).distinct(), "batch-sources")
        rows = session.read.schema(batch.schema).parquet(history).join(names, C.SOURCE_COL, "left_semi")
        rows = rows.select(*batch.columns)
        validate_feeds(rows).write.mode("overwrite").parquet(f"{status}/batch_id={batch_id}")
        validation = session.read.parquet(f"{status}/batch_id={batch_id}")
        processed = process(rows, validation, ingestion_timestamp)
        if not path_exists(session, out_path):
            write_combined(processed, out_path, overwrite="static")
            return
        ids = [C.SOURCE_COL, C.KEY_COL]
        failed = validation.where("NOT passed").select(C.SOURCE_COL)
        stored = read_feed_table(session, out_path, processed.schema)
        keys = seen.select(*ids).unionByName(stored.join(failed, C.SOURCE_COL, "left_semi").select(*ids))
        rewrite_touched(processed, out_path, ("feed_date", C.SOURCE_COL), keys=keys)

    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
