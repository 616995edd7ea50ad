"""Quality profile of raw feeds (P15, A6-A10, A17), all sources at once.

The per-source numbers come from one wide aggregation, :func:`source_metrics`,
one row per source. Report frames are reshaped from it with ``inline`` (no
second scan); a report that uses only some of the metrics gets a pruned
aggregation from the optimizer. Categorical values and date formats need a
grouping by value and have their own (single) aggregation each.

Per-source column lists (``columns_by_source``, from the CSV headers) drive
which columns each source is profiled on; without them every source is taken
to have the columns of ``df``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import (
    is_negative,
    is_negative_int,
    is_not_numeric,
    is_null_or_empty,
    is_present,
    is_zero,
    parse_double,
    strip,
)
from feedlake.functions.dates import with_date_format_bucket
from feedlake.functions.numbers import round_half_even_exact
from feedlake.operators.dedupe import duplicate_counts

ColumnsBySource = Mapping[str, Sequence[str]]


def data_columns(df: DataFrame) -> list[str]:
    """Columns of the feed itself: all but ``source_name`` and leftovers."""
    return [c for c in df.columns if c != C.SOURCE_COL and c not in C.LEFTOVER_COLUMNS]


def _has_column(column: str, columns_by_source: ColumnsBySource | None) -> Column:
    """Per-row test: does this row's source carry ``column``?"""
    if not columns_by_source:
        return F.lit(True)
    owners = [s for s, cols in columns_by_source.items() if column in cols]
    return F.col(C.SOURCE_COL).isin(owners) if owners else F.lit(False)


def _metric(name: str, column: str) -> str:
    return f"{name}__{column}"


def source_metrics(df: DataFrame, numeric: Sequence[str] = C.NUMERIC_COLUMNS,
                   null_columns: Sequence[str] | None = None, ids: DataFrame | None = None) -> DataFrame:
    """One row per source with every scalar metric of the profile and the gate.

    ``rows``; ``null_ids``, ``duplicate_ids``; per numeric column ``nonnum__c``
    (blank or not a number), ``neg__c``, ``zero__c``, ``min__c``, ``max__c``,
    ``avg__c`` (double meaning); ``negint__price``/``negint__sqft`` (integer
    meaning, for validation); per column ``empty__c`` (null or empty). ``ids``:
    the rows per (source, id) (``dedupe.id_counts``), if they are there.
    """
    cols = set(df.columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    if C.KEY_COL in cols:
        aggs.append(F.count_if(is_null_or_empty(C.KEY_COL)).alias("null_ids"))
    for c in numeric:
        if c not in cols:
            continue
        d = parse_double(c)
        aggs += [F.count_if(is_not_numeric(c)).alias(_metric("nonnum", c)),
                 F.count_if(is_negative(c)).alias(_metric("neg", c)),
                 F.count_if(is_zero(c)).alias(_metric("zero", c)),
                 F.min(d).alias(_metric("min", c)),
                 F.max(d).alias(_metric("max", c)),
                 F.avg(d).alias(_metric("avg", c))]
    for c in ("price", "sqft"):
        if c in cols:
            aggs.append(F.count_if(is_negative_int(c)).alias(_metric("negint", c)))
    for c in (null_columns if null_columns is not None else data_columns(df)):
        if c in cols:
            aggs.append(F.count_if(is_null_or_empty(c)).alias(_metric("empty", c)))
    wide = df.groupBy(C.SOURCE_COL).agg(*aggs)
    if C.KEY_COL not in cols:
        return wide
    # Distinct ids group by (source, id): that shuffle carries the two columns
    # only, not the metrics above. Both sides have one row per source.
    ids = duplicate_counts(df, ids=ids).withColumnRenamed(C.SOURCE_COL, "_ids_of")
    return wide.join(ids, F.col(C.SOURCE_COL).eqNullSafe(F.col("_ids_of"))).drop("_ids_of")


def source_stats(df: DataFrame, columns_by_source: ColumnsBySource | None = None,
                 metrics: DataFrame | None = None) -> DataFrame:
    """``rows`` and ``column_count`` per source."""
    m = metrics if metrics is not None else source_metrics(df)
    if columns_by_source:
        counts = F.create_map(*[x for s, cols in columns_by_source.items()
                                for x in (F.lit(s), F.lit(len(cols)))])
        ncols = F.element_at(counts, F.col(C.SOURCE_COL))
    else:
        ncols = F.lit(len([c for c in df.columns if c != C.SOURCE_COL]))
    return m.select(C.SOURCE_COL, F.col("rows").cast("long").alias("rows"),
                    ncols.cast("int").alias("column_count"))


def schema_issues(columns: Sequence[str],
                  expected: Sequence[str] = C.EXPECTED_COLUMNS) -> list[tuple[str, str]]:
    """P15 on one header: (column, ``missing`` | ``extra``), expected order first."""
    present = set(columns)
    missing = [(c, "missing") for c in expected if c not in present]
    extra = [(c, "extra") for c in columns
             if c not in expected and c not in C.LEFTOVER_COLUMNS and c != C.SOURCE_COL]
    return missing + extra


def schema_check(df: DataFrame, columns_by_source: ColumnsBySource | None = None,
                 expected: Sequence[str] = C.EXPECTED_COLUMNS) -> DataFrame:
    """Rows (source_name, column_name, issue) for missing and extra columns.

    A metadata check: with per-source headers it is built from them; else
    every source present in ``df`` gets the issues of ``df``'s columns.
    """
    schema = f"{C.SOURCE_COL} string, column_name string, issue string"
    spark = df.sparkSession
    if columns_by_source:
        rows = [(s, c, k) for s, cols in columns_by_source.items()
                for c, k in schema_issues(cols, expected)]
        return spark.createDataFrame(rows, schema)
    return schema_check_for_sources(df, [c for c in df.columns if c != C.SOURCE_COL], expected)


def missing_column_count(df: DataFrame, columns_by_source: ColumnsBySource | None = None,
                         expected: Sequence[str] = C.EXPECTED_COLUMNS) -> Column:
    """Per-row number of expected columns the row's source lacks."""
    if columns_by_source:
        m = F.create_map(*[x for s, cols in columns_by_source.items()
                           for x in (F.lit(s), F.lit(sum(1 for _, k in schema_issues(cols, expected)
                                                          if k == "missing")))])
        return F.coalesce(F.element_at(m, F.col(C.SOURCE_COL)), F.lit(0))
    present = set(df.columns)
    return F.lit(sum(1 for c in expected if c not in present))


def numeric_profile(df: DataFrame, numeric: Sequence[str] = C.NUMERIC_COLUMNS,
                    columns_by_source: ColumnsBySource | None = None,
                    metrics: DataFrame | None = None) -> DataFrame:
    """A6 + A7: per (source, numeric column): ``non_numeric``, ``negatives``,
    ``zeros``, ``min_value``, ``max_value``, ``avg_value`` (rounded to 2) and
    the F12 flags. Columns a source lacks are skipped.
    """
    present = [c for c in numeric if c in df.columns]
    m = metrics if metrics is not None else source_metrics(df, numeric=present, null_columns=[])
    if not present:
        return m.select(C.SOURCE_COL).where(F.lit(False))
    arr = F.array(*[F.struct(
        F.lit(c).alias("column_name"),
        F.col(_metric("nonnum", c)).cast("long").alias("non_numeric"),
        F.col(_metric("neg", c)).cast("long").alias("negatives"),
        F.col(_metric("zero", c)).cast("long").alias("zeros"),
        F.col(_metric("min", c)).alias("min_value"),
        F.col(_metric("max", c)).alias("max_value"),
        F.round(F.col(_metric("avg", c)), 2).alias("avg_value"),
    ) for c in present])
    out = m.select(C.SOURCE_COL, F.inline(arr)).withColumns({
        "has_negatives": F.col("negatives") > 0,
        "has_zeros": F.col("zeros") > 0,
        "has_non_numeric": F.col("non_numeric") > 0,
    })
    if columns_by_source:
        owns = F.lit(False)
        for c in present:
            owns = owns | ((F.col("column_name") == c) & _has_column(c, columns_by_source))
        out = out.where(owns)
    return out


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 columns_by_source: ColumnsBySource | None = None,
                 metrics: DataFrame | None = None) -> DataFrame:
    """A8 + F10 + F11: per (source, column) with at least one null or empty
    cell: ``empty_count``, ``pct`` of the source's rows (1 decimal) and the
    flag (warning sign above 10 %, else information sign).
    """
    cols = [c for c in (columns if columns is not None else data_columns(df)) if c in df.columns]
    m = metrics if metrics is not None else source_metrics(df, numeric=[], null_columns=cols)
    if not cols:
        return m.select(C.SOURCE_COL).where(F.lit(False))
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"),
                             F.col(_metric("empty", c)).cast("long").alias("empty_count"))
                    for c in cols])
    # Python's round on the exact value (half even), as the original report.
    pct = round_half_even_exact(F.col("empty_count") / F.col("rows") * 100, 1)
    out = (m.select(C.SOURCE_COL, "rows", F.inline(arr))
            .where(F.col("empty_count") > 0)
            .withColumn("pct", pct)
            .withColumn("flag", F.when(F.col("pct") > C.NULL_PCT_WARN_ABOVE, F.lit(C.ICON_WARN))
                                 .otherwise(F.lit(C.ICON_INFO)))
            .select(C.SOURCE_COL, "column_name", "empty_count", "pct", "flag"))
    if columns_by_source:
        owns = F.lit(False)
        for c in cols:
            owns = owns | ((F.col("column_name") == c) & _has_column(c, columns_by_source))
        out = out.where(owns)
    return out


def _long_values(df: DataFrame, columns: Sequence[str],
                 columns_by_source: ColumnsBySource | None) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"),
                             F.when(_has_column(c, columns_by_source),
                                    F.col(c).cast("string")).alias("value"))
                    for c in columns])
    return df.select(C.SOURCE_COL, F.inline(arr))


def category_profile(df: DataFrame, columns: Sequence[str] = C.CATEGORICAL_COLUMNS,
                     columns_by_source: ColumnsBySource | None = None) -> DataFrame:
    """Distinct non-empty values per (source, categorical column), long
    form, with ``n_rows``. One aggregation; partial counts before the shuffle
    keep a dominant value cheap.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.select(C.SOURCE_COL).where(F.lit(False))
    return (_long_values(df, present, columns_by_source)
            .where(is_present("value"))
            .groupBy(C.SOURCE_COL, "column_name", "value")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def date_format_profile(df: DataFrame, columns: Sequence[str] = C.DATE_COLUMNS,
                        extended: bool = False,
                        columns_by_source: ColumnsBySource | None = None) -> DataFrame:
    """A10 + F2 over every row: per (source, date column, format) the row count
    and the smallest stripped value as a sample. ``empty`` counts null and
    blank cells; texts of no known format are bucketed as ``UNKNOWN``.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.select(C.SOURCE_COL).where(F.lit(False))
    owned = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                      _has_column(c, columns_by_source).alias("_owned"))
             for c in present]
    long = df.select(C.SOURCE_COL, F.inline(F.array(*owned))).where("_owned")
    keys = [C.SOURCE_COL, "column_name", "date_format"]
    # Count per distinct text first (hash aggregation, partial counts before
    # the shuffle); only those distinct texts reach the ``min`` for a sample.
    per_text = (with_date_format_bucket(long, "value", "date_format", extended)
                .groupBy(*keys, strip(F.col("value")).alias("text"))
                .agg(F.count(F.lit(1)).alias("n")))
    return per_text.groupBy(*keys).agg(F.sum("n").cast("long").alias("n_rows"),
                                       F.min("text").alias("sample_value"))


def value_counts(df: DataFrame, categorical: Sequence[str] = C.CATEGORICAL_COLUMNS,
                 dates: Sequence[str] = C.DATE_COLUMNS, extended: bool = False,
                 columns_by_source: ColumnsBySource | None = None) -> DataFrame:
    """A9 and A10 in one aggregation: rows per (source, kind, column, value,
    date_format), ``kind`` being ``category`` or ``date``.

    One scan and one shuffle serve both reports; partial counts run before
    the shuffle. The result is bounded by the distinct values, not the rows.
    Derive the reports with :func:`categories_from_values` and
    :func:`date_formats_from_values`.
    """
    cats = [c for c in categorical if c in df.columns]
    dts = [c for c in dates if c in df.columns]
    cells = ([F.struct(F.lit("category").alias("kind"), F.lit(c).alias("column_name"),
                       F.col(c).cast("string").alias("value"),
                       _has_column(c, columns_by_source).alias("_owned")) for c in cats]
             + [F.struct(F.lit("date").alias("kind"), F.lit(c).alias("column_name"),
                         F.col(c).cast("string").alias("value"),
                         _has_column(c, columns_by_source).alias("_owned")) for c in dts])
    if not cells:
        return df.select(C.SOURCE_COL).where(F.lit(False))
    long = df.select(C.SOURCE_COL, F.inline(F.array(*cells))).where("_owned")
    is_date = F.col("kind") == "date"
    # Only date cells go through the classifier (others are null there: no regex).
    labelled = with_date_format_bucket(long.withColumn("_dv", F.when(is_date, F.col("value"))),
                                       "_dv", "_fmt", extended)
    keyed = labelled.select(
        C.SOURCE_COL, "kind", "column_name",
        F.when(is_date, strip(F.col("value"))).otherwise(F.col("value")).alias("value"),
        F.when(is_date, F.col("_fmt")).alias("date_format"))
    keyed = keyed.where(is_date | is_present("value"))
    return (keyed.groupBy(C.SOURCE_COL, "kind", "column_name", "value", "date_format")
                 .agg(F.count(F.lit(1)).alias("n")))


def categories_from_values(values: DataFrame) -> DataFrame:
    """A9 from :func:`value_counts`: (source, column, value, ``n_rows``)."""
    return (values.where(F.col("kind") == "category")
                  .select(C.SOURCE_COL, "column_name", "value",
                          F.col("n").cast("long").alias("n_rows")))


def date_formats_from_values(values: DataFrame) -> DataFrame:
    """A10 from :func:`value_counts`: (source, column, format, ``n_rows``,
    ``sample_value``)."""
    keys = [C.SOURCE_COL, "column_name", "date_format"]
    return (values.where(F.col("kind") == "date").groupBy(*keys)
                  .agg(F.sum("n").cast("long").alias("n_rows"),
                       F.min("value").alias("sample_value")))


def date_samples(values: DataFrame, k: int = 3) -> DataFrame:
    """L4 from :func:`value_counts`: per (source, date column) the ``k``
    smallest non-blank texts, with their format; ``sample_rank`` 1..k. The
    top-k keeps at most ``k`` rows per group from each task before the shuffle.
    """
    from feedlake.operators.topk import top_k_per_group

    texts = values.where((F.col("kind") == "date") & F.col("value").isNotNull()
                         & (F.col("value") != ""))
    return (top_k_per_group(texts, [C.SOURCE_COL, "column_name"], [F.col("value").asc()], k,
                            rank_col="sample_rank")
            .select(C.SOURCE_COL, "column_name", F.col("value").alias("sample_value"),
                    "date_format", "sample_rank"))


def schema_check_for_sources(sources: DataFrame, columns: Sequence[str],
                             expected: Sequence[str] = C.EXPECTED_COLUMNS) -> DataFrame:
    """P15 for the sources listed in ``sources`` (any frame with
    ``source_name``), all sharing the header ``columns``."""
    schema = f"{C.SOURCE_COL} string, column_name string, issue string"
    issues = schema_issues(list(columns), expected)
    if not issues:
        return sources.sparkSession.createDataFrame([], schema)
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("issue"))
                    for c, k in issues])
    return sources.select(C.SOURCE_COL).distinct().select(C.SOURCE_COL, F.inline(arr))
