"""Profiles that grow by a day (G7, A3, A5-A10): stored partial results that add up.

Under a root, each day's raw rows leave three tables of its own: ``metrics`` (one row
per source: counts, sums, least and greatest values), ``values`` (rows per categorical
value and date text) and ``ids`` (rows per source and id). All of them are sums,
minima or maxima, so the profile of all days follows from their partial results: the
profile after a further day reads that day's rows and no other's. A day that is
added again replaces what it left before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import parse_double
from feedlake.operators import source_metrics
from feedlake.operators.dedupe import id_counts
from feedlake.operators.profile import _has_column, value_counts
from feedlake.operators.topk import top_k_per_group
from feedlake.plans.pipeline import Profile
from feedlake.session import stored_copy
from feedlake.sinks.versions import is_written

TABLES = ("metrics", "values", "ids")


@dataclass
class MergedProfile(Profile):
    """G7 from stored partial results; ``parts``: the three tables, all days."""

    parts: Mapping[str, DataFrame] | None = None

    @cached_property
    def metrics(self) -> DataFrame:
        day = self.parts["metrics"]
        merged = []
        for c in day.columns:
            kind = c.split("__")[0]
            if c == C.SOURCE_COL or kind in ("sum", "num"):
                continue
            column = c.removeprefix("avg__")
            merged.append(F.min(c).alias(c) if kind == "min" else F.max(c).alias(c) if kind == "max" else
                          (F.sum(f"sum__{column}") / F.sum(f"num__{column}")).alias(c) if kind == "avg" else
                          F.sum(c).alias(c))
        sums = day.groupBy(C.SOURCE_COL).agg(*merged).drop("duplicate_ids")
        again = (self.id_counts.groupBy(F.col(C.SOURCE_COL).alias("ids_of"))
                     .agg(F.sum(F.col("n") - 1).cast("long").alias("duplicate_ids")))
        return stored_copy(sums.join(again, sums[C.SOURCE_COL].eqNullSafe(again["ids_of"])).drop("ids_of"), "metrics")

    @cached_property
    def id_counts(self) -> DataFrame:
        """``source_name, property_id, n`` over all days."""
        return self.parts["ids"].groupBy(C.SOURCE_COL, C.KEY_COL).agg(F.sum("n").alias("n"))

    @cached_property
    def values(self) -> DataFrame:
        day = self.parts["values"]
        if self.columns_by_source:
            names = dict.fromkeys([*C.CATEGORICAL_COLUMNS, *C.DATE_COLUMNS])
            day = day.where(F.coalesce(*[F.when(F.col("column_name") == c, _has_column(c, self.columns_by_source))
                                         for c in names]))
        keys = [c for c in day.columns if c != "n"]
        return stored_copy(day.groupBy(*keys).agg(F.sum("n").cast("long").alias("n")), "values")

    @property
    def duplicates(self) -> DataFrame:
        more = self.id_counts.where("n > 1").withColumnRenamed("n", "occurrences")
        return top_k_per_group(more, [C.SOURCE_COL], [F.col("occurrences").desc(), F.col(C.KEY_COL).asc_nulls_first()], 5)


@dataclass
class ProfileStore:
    """Partial profiles under ``root``, of feeds with the given columns."""

    spark: SparkSession
    root: str
    columns: Sequence[str] = C.EXPECTED_COLUMNS
    extended_dates: bool = False

    def _path(self, table: str, day: str) -> str:
        return f"{self.root.rstrip('/')}/{table}/day={day}"

    def _conform(self, raw: DataFrame) -> DataFrame:
        return raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in self.columns],
                          C.SOURCE_COL)

    def _metrics(self, rows: DataFrame, ids: DataFrame) -> DataFrame:
        numbers = [c for c in C.NUMERIC_COLUMNS if c in self.columns]
        sums = rows.groupBy(F.col(C.SOURCE_COL).alias("sums_of")).agg(
            *[F.sum(parse_double(c)).alias(f"sum__{c}") for c in numbers],
            *[F.count(parse_double(c)).alias(f"num__{c}") for c in numbers], F.count(F.lit(1)).alias("num__rows"))
        metrics = source_metrics(rows, ids=ids)
        return metrics.join(sums, metrics[C.SOURCE_COL].eqNullSafe(sums["sums_of"])).drop("sums_of")

    def _partials(self, rows: DataFrame) -> dict[str, DataFrame]:
        ids = id_counts(rows)
        return {"ids": ids, "metrics": self._metrics(rows, ids),
                "values": value_counts(rows, extended=self.extended_dates)}

    def add(self, day: str, raw: DataFrame, once: bool = True) -> None:
        """Store the partial results of a day's raw rows. These are read several times and are
        stored first, so that they are computed once; ``once=False`` if ``raw`` is a plain read
        of stored rows. The day's ids are grouped once: duplicates are counted from the stored ones."""
        rows = self._conform(raw)
        rows = stored_copy(rows, "day", "zstd") if once else rows
        parts = self._partials(rows)
        parts["ids"].write.mode("overwrite").parquet(self._path("ids", day))
        ids = self.spark.read.schema(parts["ids"].schema).parquet(self._path("ids", day))
        self._metrics(rows, ids).write.mode("overwrite").parquet(self._path("metrics", day))
        parts["values"].write.mode("overwrite").parquet(self._path("values", day))

    def profile(self, days: Sequence[str], columns_by_source: Mapping[str, Sequence[str]] | None = None,
                errors: Mapping[str, str] | None = None) -> MergedProfile:
        """The profile of the rows of these days; the days' raw rows are not read."""
        missing = [d for d in days if not all(is_written(self.spark, self._path(t, d)) for t in TABLES)]
        if missing:
            raise ValueError(f"days that were not added: {', '.join(missing)}")
        empty = self.spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*self.columns, C.SOURCE_COL]))
        kinds = self._partials(self._conform(empty))
        parts = {t: self.spark.read.schema(kinds[t].schema).parquet(*[self._path(t, d) for d in days]) if days else kinds[t]
                 for t in TABLES}
        return MergedProfile(empty, columns_by_source, errors, self.extended_dates, parts)
