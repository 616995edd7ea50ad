"""CSV feed sources (S1, S2): one frame for all sources, plus header metadata.

Each source directory holds daily CSV files with a header row. Every cell is
read as text (no schema inference), PERMISSIVE mode, comma separated, ``"``
quoting (addresses hold commas). Blank and ``""`` cells read as null.

``read_feed_scan`` reads all sources as one scan and matches cells by the
header of each file; ``read_feeds`` reads each source on its own. A source
that cannot be read, or whose header lacks ``property_id`` (a directory with
only an empty file gives no lines at all), is recorded in ``FeedSet.errors``
and left out; the others go on.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import config as C
from feedlake.operators.combine import combine_sources
from feedlake.session import stored_copy
from feedlake.sinks import path_exists
from feedlake.sources.heads import file_heads, hadoop_heads

log = logging.getLogger(__name__)


@dataclass
class FeedSet:
    """All readable sources as one frame, with per-source metadata.

    ``columns`` maps each readable source to its header (file order);
    ``errors`` maps each unreadable source to the reason. From the one-scan
    reader also ``malformed`` (``source_name, feed_file, line``: rows whose cells are
    not as many as their file's names) and ``heads`` (``file, header, error``).
    """

    df: DataFrame | None
    columns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    malformed: DataFrame | None = None
    heads: DataFrame | None = None

    @property
    def sources(self) -> list[str]:
        return list(self.columns) + [s for s in self.errors if s not in self.columns]


def source_paths(root: str, sources: Sequence[str] = C.DEFAULT_SOURCES) -> dict[str, str]:
    """S2 layout: ``{root}/{source}/raw-data/`` per source."""
    base = root.rstrip("/")
    return {s: f"{base}/{s}/raw-data/" for s in sources}


def _csv_reader(spark: SparkSession, schema: T.StructType | None):
    # Spark's CSV defaults otherwise (comma, double-quote quoting, backslash escape).
    reader = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
              .option("sep", ",").option("quote", '"'))
    if schema is not None:
        # A header that disagrees with the schema fails the read instead of
        # being taken by position.
        return reader.schema(schema).option("enforceSchema", "false")
    return reader.option("inferSchema", "false")


def read_feed(spark: SparkSession, path: str | Sequence[str], source_name: str,
              schema: T.StructType | None = None) -> DataFrame:
    """One source's CSV files as text columns plus ``source_name``.

    Without ``schema`` the header of the files names the columns (one small
    job reads it); with ``schema`` no inference job runs and every file's
    header is checked against it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = _csv_reader(spark, schema).csv(paths)
    return df.withColumn(C.SOURCE_COL, F.lit(source_name))


def list_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Files under ``path`` as Spark lists them (parallel listing for many)."""
    paths = [path] if isinstance(path, str) else list(path)
    return sorted(spark.read.format("text").load(paths).inputFiles())


def file_headers(spark: SparkSession, files: Sequence[str]) -> dict[str, tuple[str, ...] | None]:
    """First non-blank line of each file, split as a CSV header; ``None`` for an empty file.

    Reads only the start of each file through the cluster's file system
    (metadata, like schema inference).
    """
    return {f: tuple(header) if header else None for f, header, _ in hadoop_heads(spark, files)}


def read_feed_strict(spark: SparkSession, path: str | Sequence[str], source_name: str) -> DataFrame:
    """S1 with every file read under its own header, then joined by name.

    Files are grouped by header; each group is one CSV read, so a file whose
    columns come in another order is matched by name, not by position.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, header in file_headers(spark, list_files(spark, path)).items():
        if header:
            groups.setdefault(header, []).append(f)
    if not groups:
        raise AnalysisException(f"no header found under {path}")
    frames = [read_feed(spark, files, source_name) for files in groups.values()]
    return combine_sources(frames)


def read_feeds(spark: SparkSession, paths: Mapping[str, str | Sequence[str]],
               schema: T.StructType | None = None, strict_header: bool = True) -> FeedSet:
    """Every source of ``paths`` (source -> directory or files) as one frame.

    ``strict_header`` reads each file under its own header (see
    :func:`read_feed_strict`); otherwise one header serves a source's files.
    """
    frames: list[DataFrame] = []
    columns: dict[str, tuple[str, ...]] = {}
    errors: dict[str, str] = {}
    for source, path in paths.items():
        try:
            if strict_header and schema is None:
                df = read_feed_strict(spark, path, source)
            else:
                df = read_feed(spark, path, source, schema)
        except AnalysisException as e:
            errors[source] = _reason(e)
            continue
        header = tuple(c for c in df.columns if c != C.SOURCE_COL)
        if C.KEY_COL not in header:
            errors[source] = f"missing column {C.KEY_COL}" if header else "no columns found"
            continue
        columns[source] = header
        frames.append(df)
    for s, msg in errors.items():
        log.warning("source %s left out: %s", s, msg)
    return FeedSet(combine_sources(frames), columns, errors)


_SOURCE_IN_PATH = r"/([^/]+)/raw-data/[^/]*$"
#: Of the scan: the raw line of a row whose cells are not as many as its file's names.
MALFORMED = "malformed_line"
FILE = "feed_file"


def source_files(spark: SparkSession, places: Mapping[str, str]) -> dict[str, list[str]]:
    """The files under each source's place, as Spark lists them. A place that isn't there has none."""
    there = {s: p for s, p in places.items() if path_exists(spark, p)}
    found: dict[str, list[str]] = {s: [] for s in places}
    if not there:
        return found
    # Files without a byte are not listed; contents are not read.
    roots = {s: _qualified(spark, p).rstrip("/") for s, p in there.items()}
    by_root = {r: s for s, r in roots.items()}
    for row in spark.read.format("binaryFile").load(list(there.values())).select("path").toLocalIterator():
        folder = row["path"].rsplit("/", 1)[0]
        while folder and folder not in by_root:
            folder = folder.rpartition("/")[0]
        if folder:
            found[by_root[folder]].append(row["path"])
    return found


def _qualified(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(p).toString()


def _one_header(spark: SparkSession, files: Sequence[str], header: Sequence[str], pattern: str) -> DataFrame:
    """Rows of files that share a header, as its names; the first line of each is not a row, whatever
    it holds, and every other line is. Cells that a row lacks are null."""
    cells = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, MALFORMED]])
    lines = (spark.read.schema(schema).option("header", "true").option("enforceSchema", "true")
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
             # All cells are parsed, so that a row is judged alike whatever columns a query reads.
             .option("columnPruning", "false")
             .option("sep", ",").option("quote", '"').option("maxColumns", max(20480, len(header) + 1)).csv(list(files)))
    place: dict[str, int] = {}
    known: set[str] = set()
    for i, name in enumerate(header):
        if name and name.lower() not in known:
            known.add(name.lower())
            place[name] = i
    # The path is escaped like a URL's, in which a plus sign is itself.
    file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return lines.select(*[F.col(f"c{i}").alias(name) for name, i in place.items()],
                        F.regexp_extract(file, pattern, 1).alias(C.SOURCE_COL), file.alias(FILE), MALFORMED)


def read_feed_scan(spark: SparkSession, root: str, sources: Sequence[str] = C.DEFAULT_SOURCES,
                   layout: str = "{source}/raw-data/", pattern: str = _SOURCE_IN_PATH) -> FeedSet:
    """S1 + S2 for any number of sources as ONE scan of the folders ``{root}/{layout}``;
    ``pattern`` finds the source in a file's path.

    Cells are matched by name, and a file's header is its first line that isn't
    blank: found by place and not by what it says, from the file's first bytes
    (see ``heads``). Files with the same header are read together, so the plan
    has one scan for each distinct header and reads each file once. A data cell
    that reads ``property_id``, and a header line repeated further down, are
    data.

    A source fails alone, with the reason, if it has no files, a file without
    ``property_id`` in its header, or a file that can't be read; an empty file
    beside others is ignored. Finding that out reads no other source again.

    Rows that have too few or too many cells stay in ``df`` as the CSV reader
    leaves them, and ``malformed`` has their raw lines.
    """
    base = root.rstrip("/")
    places = {s: f"{base}/{layout.format(source=s)}" for s in dict.fromkeys(sources)}
    files = source_files(spark, places)
    owner = {f: s for s, some in files.items() for f in some}
    errors: dict[str, str] = {s: f"no files under {places[s]}" for s, some in files.items() if not some}
    heads = stored_copy(file_heads(spark, list(owner)), "heads")
    groups: dict[tuple[str, ...], list[str]] = {}
    columns: dict[str, tuple[str, ...]] = {}
    for r in heads.orderBy("file").toLocalIterator():
        source, header = owner[r["file"]], tuple(x.strip() for x in r["header"] or ())
        if r["error"] is not None:
            errors.setdefault(source, f"{r['file']}: {r['error']}")
        elif header and C.KEY_COL not in header:
            errors.setdefault(source, f"a file has no header with {C.KEY_COL}")
        elif header:
            groups.setdefault(header, []).append(r["file"])
            columns[source] = tuple(dict.fromkeys([*columns.get(source, ()), *(c for c in header if c)]))
    errors.update({s: f"missing column {C.KEY_COL}" for s in files if s not in columns and s not in errors})
    columns = {s: c for s, c in columns.items() if s not in errors}
    for s, msg in errors.items():
        log.warning("source %s left out: %s", s, msg)
    frames = [_one_header(spark, some, header, pattern) for header, listed in groups.items()
              if (some := [f for f in listed if owner[f] not in errors])]
    if not frames:
        return FeedSet(None, {}, errors)
    rows = combine_sources(frames)
    every = list(dict.fromkeys(c for cols in columns.values() for c in cols))
    every = [c for c in C.EXPECTED_COLUMNS if c in every] + [c for c in every if c not in C.EXPECTED_COLUMNS]
    every = [c for c in every if c in rows.columns]
    # Not null for malformed rows alone. The CSV reader refuses a query of that column without a cell.
    reads_cells = F.length(MALFORMED) + F.coalesce(F.length(C.KEY_COL), F.lit(0))
    bad = rows.where(reads_cells >= 0).select(C.SOURCE_COL, FILE, F.col(MALFORMED).alias("line"))
    return FeedSet(rows.select(*[F.col(f"`{c}`") for c in every], C.SOURCE_COL), columns, errors, bad, heads)


def malformed_counts(malformed: DataFrame) -> DataFrame:
    """``source_name, malformed_rows`` from a feed's malformed rows (or their quarantine)."""
    return malformed.groupBy(C.SOURCE_COL).agg(F.count(F.lit(1)).alias("malformed_rows"))


def quarantine(feeds: FeedSet, path: str) -> DataFrame:
    """Store a feed's malformed rows (source, file, raw line), one folder per source, and read them back."""
    (feeds.malformed.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(C.SOURCE_COL).parquet(path))
    schema = T.StructType([f for f in feeds.malformed.schema if f.name != C.SOURCE_COL]).add(C.SOURCE_COL, "string")
    return feeds.malformed.sparkSession.read.schema(schema).parquet(path)


def read_feed_root(spark: SparkSession, root: str,
                   sources: Sequence[str] = C.DEFAULT_SOURCES,
                   schema: T.StructType | None = None, strict_header: bool = True) -> FeedSet:
    """S1 + S2 over the ``{root}/{source}/raw-data/`` layout: one scan, cells matched by
    name. With ``schema``, or ``strict_header=False`` (one header for a source's
    files, cells by position), each source is read on its own."""
    if schema is None and strict_header:
        return read_feed_scan(spark, root, sources)
    return read_feeds(spark, source_paths(root, sources), schema, strict_header)


def _reason(e: Exception) -> str:
    return str(e).strip() or type(e).__name__
