"""Incremental loads whose cost follows the new rows (I1), as batches or a file stream.

Under a store's root:

- ``state/index/batch=<n>``: the survivor index, one row per (source, id) of
  batch n with the least of its cleaned rows in the dedupe's order. Survivors are
  minima, so those of all batches are merged by a minimum and nothing is ever
  rewritten: a late row that takes over is just a smaller value.
- ``state/metrics/batch=<n>``: the sums that validation needs, per source, and how
  many ids were new. Sums over all batches are the validation of all rows.
- ``data``, ``versions``: the table (see ``sinks.versions``).
- ``ledger/batch=<n>/stage=<name>``: one row per stage of a batch with its status.

A batch reads its new rows, the index entries of its ids, and the folders that
hold an id whose survivor changed. It never reads older raw rows or other folders.
The table equals a full load of all rows seen.

A batch has four stages: ``index``, ``metrics``, ``data``, ``publish``. Each
writes under a path of its own, so a batch that stopped is repeated from the first
stage that isn't done; with another ``input_version`` from the start. Publishing
is one switch. A batch that was published is not applied again.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedlake import config as C
from feedlake.operators import clean, enrich
from feedlake.operators.validate import first_measures, verdicts
from feedlake.session import stored_copy
from feedlake.sinks.parquet import path_exists, same_folder
from feedlake.sinks.versions import LAYOUT, current_version, folders, is_written, read_folders, read_version, replace_folders
from feedlake.streaming.incremental import raw_feed_schema, source_from_path

log = logging.getLogger(__name__)

IDS = (C.KEY_COL, C.SOURCE_COL)  # sorts by them compare ids first, in which most rows differ
STAGES = ("index", "metrics", "data", "publish")
_LEDGER = "status string, input_version string, details string, at string"


@dataclass
class FeedStore:
    """A store of feeds under ``root``; ``columns``: the raw columns it keeps, in the order by which
    the least row of an id survives (rows are compared column by column)."""

    spark: SparkSession
    root: str
    columns: Sequence[str] = C.EXPECTED_COLUMNS

    # -- paths and schemas ------------------------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.StringType()) for c in dict.fromkeys([*self.columns, C.SOURCE_COL])]))

    def conform(self, raw: DataFrame) -> DataFrame:
        """``raw`` with the store's columns; those it lacks are null."""
        extra = [c for c in raw.columns if c not in self.columns and c != C.SOURCE_COL and c not in C.LEFTOVER_COLUMNS]
        if extra:
            raise ValueError(f"columns that the store does not keep: {', '.join(extra)}; name them when it is opened")
        names = list(dict.fromkeys([*self.columns, C.SOURCE_COL]))
        return raw.select(*[F.col(c).cast("string").alias(c) if c in raw.columns else F.lit(None).cast("string").alias(c)
                            for c in names])

    @property
    def _values(self) -> list[str]:
        return [c for c in self._empty().columns if c not in IDS]

    @property
    def _index_schema(self) -> T.StructType:
        cleaned = clean(self._empty()).schema
        return T.StructType([*(cleaned[c] for c in IDS), T.StructField("first", T.StructType([cleaned[c] for c in self._values])),
                             T.StructField("rows", T.LongType())])

    @property
    def schema(self) -> T.StructType:
        """Of the table."""
        return enrich(clean(self._empty()), "").schema

    def _batches(self, what: str, upto: int) -> list[str]:
        return [p for n in range(1, upto + 1) if is_written(self.spark, p := self._path("state", what, f"batch={n}"))]

    # -- ledger -----------------------------------------------------------------------------------

    def ledger(self) -> DataFrame:
        """``batch, stage, status, input_version, details, at`` of every stage tried last."""
        path = self._path("ledger")
        schema = f"{_LEDGER}, batch long, stage string"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _note(self, batch: int, stage: str, status: str, input_version: str, details: str = "") -> None:
        values = (status, input_version, details[:2000], datetime.now(timezone.utc).isoformat())
        names = [c.split()[0] for c in _LEDGER.split(",")]
        (self.spark.range(1, numPartitions=1).select(*[F.lit(v).alias(c) for c, v in zip(names, values, strict=True)])
         .write.mode("overwrite").parquet(self._path("ledger", f"batch={batch}", f"stage={stage}")))

    def status(self) -> DataFrame:
        """``batch`` and the validation as of it, one row per source: what each batch published knew."""
        published = current_version(self.spark, self.root) or 0
        known = verdicts(first_measures(self._empty()).withColumn("duplicate_ids", F.lit(0).cast("long")))
        paths = self._batches("validation", published)
        if not paths:
            return known.withColumn("batch", F.lit(None).cast("long"))
        return (self.spark.read.schema(known.schema.add("batch", "long"))
                .option("basePath", self._path("state", "validation")).parquet(*paths))

    def _done(self, batch: int, input_version: str) -> set[str]:
        """Stages of the batch that are done for this input."""
        rows = self.ledger().where(F.col("batch") == batch).collect()  # at most one per stage
        return {r["stage"] for r in rows if r["status"] == "done" and r["input_version"] == input_version}

    # -- a batch ----------------------------------------------------------------------------------

    def apply(self, raw: DataFrame, batch: int | None = None, ingestion_timestamp: str | None = None,
              input_version: str = "") -> int:
        """Add the rows of ``raw`` (``source_name`` and raw columns). ``batch``: its number, from 1
        without gaps (the next one). Repeating a published batch changes nothing; one
        that stopped goes on where it did. Returns the batch's number."""
        published = current_version(self.spark, self.root) or 0
        batch = published + 1 if batch is None else batch
        if batch <= published:
            log.info("batch %s is published already", batch)
            return batch
        if batch != published + 1:
            raise ValueError(f"batch {batch} does not follow {published}, the last one published")
        rows = self.conform(raw)
        steps: Mapping[str, Callable[[], None]] = {
            "index": lambda: self._write_index(rows, batch),
            "metrics": lambda: self._write_metrics(rows, batch),
            "data": lambda: self._write_changed(batch),
            "publish": lambda: self._publish(batch, ingestion_timestamp),
        }
        done = self._done(batch, input_version)
        for stage in STAGES:
            if stage in done:
                continue
            done = set()  # what follows a stage that runs, runs
            try:
                steps[stage]()
            except Exception as e:
                self._note(batch, stage, "failed", input_version, f"{type(e).__name__}: {e}")
                raise
            self._note(batch, stage, "done", input_version)
        return batch

    def _write_index(self, rows: DataFrame, batch: int) -> None:
        first = F.min(F.struct(*self._values)).alias("first")
        (clean(rows).groupBy(*IDS).agg(first, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").parquet(self._path("state", "index", f"batch={batch}")))

    def _new_ids(self, batch: int) -> DataFrame:
        return self.spark.read.schema(self._index_schema).parquet(self._path("state", "index", f"batch={batch}"))

    def _older(self, batch: int) -> DataFrame:
        """``before`` of the batch's ids that batches before it have: their survivors so far."""
        new = self._new_ids(batch).select(*IDS)
        paths = self._batches("index", batch - 1)
        if not paths:
            return self._new_ids(batch).limit(0).select(*IDS, F.col("first").alias("before"))
        older = self.spark.read.schema(self._index_schema).parquet(*paths)
        return (older.join(new, same_folder(older, new, IDS), "left_semi")
                     .groupBy(*IDS).agg(F.min("first").alias("before")))

    def _write_metrics(self, rows: DataFrame, batch: int) -> None:
        new, older = self._new_ids(batch), self._older(batch)
        fresh = (new.join(older, same_folder(new, older, IDS), "left_anti")
                    .groupBy(F.col(C.SOURCE_COL).alias("ids_of")).agg(F.count(F.lit(1)).alias("new_ids")))
        sums = first_measures(rows)
        (sums.join(fresh, sums[C.SOURCE_COL].eqNullSafe(fresh["ids_of"]), "left").drop("ids_of")
             .withColumn("new_ids", F.coalesce("new_ids", F.lit(0)))
             .write.mode("overwrite").parquet(self._path("state", "metrics", f"batch={batch}")))

    def validation(self, upto: int | None = None, sources: Sequence[str] | None = None,
                   errors: Mapping[str, str] | None = None) -> DataFrame:
        """G1 over all rows of the batches (up to one), from their sums."""
        upto = (current_version(self.spark, self.root) or 0) if upto is None else upto
        paths = self._batches("metrics", upto)
        schema = f"{C.SOURCE_COL} string, total_rows long, null_ids long, negative_prices long, negative_sqft long, new_ids long"
        sums = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        stats = sums.groupBy(C.SOURCE_COL).agg(*[F.sum(c).alias(c) for c in sums.columns if c != C.SOURCE_COL])
        stats = stats.withColumn("duplicate_ids", F.col("total_rows") - F.col("new_ids")).drop("new_ids")
        return verdicts(stats, sources, errors)

    def _changed(self, batch: int) -> DataFrame:
        if not self._batches("index", batch - 1):  # every id is set by the batch
            old_date = F.lit(None).cast("string").alias("old_date")
            return self._new_ids(batch).select(*IDS, "first", F.lit(False).alias("moved"), old_date)
        return self.spark.read.parquet(self._path("state", "changed", f"batch={batch}"))

    def _write_changed(self, batch: int) -> None:
        """Ids whose survivor the batch sets: ``first``, and where the one before it is. Of the first
        batch these are its index."""
        if not self._batches("index", batch - 1):
            return
        new, older = self._new_ids(batch), self._older(batch)
        older = older.select(*[F.col(c).alias(f"old_{c}") for c in IDS], "before")
        same = F.lit(True)
        for c in IDS:
            same = same & new[c].eqNullSafe(older[f"old_{c}"])
        changed = (new.join(older, same, "left").where(F.col("before").isNull() | (F.col("first") < F.col("before")))
                      .select(*IDS, "first", F.col("before").isNotNull().alias("moved"),
                              F.col("before.feed_date").alias("old_date")))
        changed.write.mode("overwrite").parquet(self._path("state", "changed", f"batch={batch}"))

    def _publish(self, batch: int, ingestion_timestamp: str | None) -> None:
        validation = stored_copy(self.validation(batch), "validation")
        validation.write.mode("overwrite").parquet(self._path("state", "validation", f"batch={batch}"))
        passed = validation.where("passed").select(C.SOURCE_COL)
        changed = self._changed(batch)
        changed = changed.join(passed, C.SOURCE_COL, "left_semi").select(*changed.columns)
        moved = changed.where("moved").select(F.col("old_date").alias("feed_date"), C.SOURCE_COL)
        set_in = changed.select(F.col("first.feed_date").alias("feed_date"), C.SOURCE_COL)
        touched = stored_copy(moved.unionByName(set_in).distinct(), "touched")
        listed = stored_copy(folders(self.spark, self.root), "folders")
        held = listed.join(touched, same_folder(listed, touched, LAYOUT), "left_semi")
        old = read_folders(self.spark, self.root, held, self.schema)
        taken = changed.where("moved").select(*IDS)
        stay = old.join(taken, same_folder(old, taken, IDS), "left_anti")
        survivors = changed.select(*IDS, *[F.col(f"first.{c}").alias(c) for c in self._values])
        fresh = enrich(survivors.select(*self._empty().columns), ingestion_timestamp)
        left_out = listed.join(passed, C.SOURCE_COL, "left_anti")
        replace_folders(self.spark, self.root, batch, stay.unionByName(fresh).select(*self.schema.names), touched, left_out)

    def read(self, version: int | None = None) -> DataFrame:
        """The table, as of the last batch published or an earlier one (until its folders are vacuumed)."""
        return read_version(self.spark, self.root, self.schema, version)


def start_store_stream(store: FeedStore, root: str, checkpoint: str, schema: T.StructType | None = None,
                       ingestion_timestamp: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Apply all new feed files under ``{root}/*/raw-data/`` to a store, a batch each, and stop
    (``availableNow``). The stream's checkpoint is the bookmark of the files; a batch
    that is replayed after it was published changes nothing. A store is fed by one stream,
    or by ``apply``."""
    reader = (store.spark.readStream.schema(schema or raw_feed_schema(store.columns))
              .option("header", "true").option("enforceSchema", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.csv(f"{root.rstrip('/')}/*/raw-data/").withColumn(C.SOURCE_COL, source_from_path(root))

    def handle(batch: DataFrame, batch_id: int) -> None:
        FeedStore(batch.sparkSession, store.root, store.columns).apply(batch, batch_id + 1, ingestion_timestamp,
                                                                      f"stream batch {batch_id}")

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
