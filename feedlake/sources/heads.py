"""First lines of the feed's files, read on the executors from the files' first bytes.

One job over the list of files opens each file, reads up to the end of its
first line that isn't blank, and closes it: one row per file, with its names or
the reason why it can't be read. A compressed file is read through, since
only its end shows whether it is whole; it is one task's file in any case.

Executors open files through ``pyarrow.fs`` (local and mounted paths, HDFS, S3,
GCS). Paths of other file systems are opened by the driver through Hadoop's,
their first lines only.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

HEAD_BYTES = 1 << 16
READ_BYTES = 1 << 22
HEADER_READ_THREADS = 16   # the driver's concurrent reads, where executors can't open a path
FILES_PER_TASK = 64
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
SCHEMA = "file string, header array<string>, error string"
_ARROW_SCHEMA = pa.schema([("file", pa.string()), ("header", pa.list_(pa.string())), ("error", pa.string())])
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a name as Hadoop writes it: nothing in it is escaped."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{quote(rest, safe='/:@')}")


def first_line(stream, whole: bool) -> str | None:
    """The first line with text of an open stream; ``whole``: then read the stream to its end."""
    held, line = b"", None
    while line is None:
        more = stream.read(HEAD_BYTES)
        held += more
        *lines, rest = held.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        if not more:
            lines, rest = [*lines, rest], b""
        line = next((x for x in lines if x.strip()), None)
        if not more:
            break
        if line is None:
            held = rest
    while whole and stream.read(READ_BYTES):
        pass
    return None if line is None else line.decode("utf-8-sig", "replace")


def names_of(line: str | None) -> list[str]:
    csv.field_size_limit(sys.maxsize)
    return [] if line is None else next(csv.reader([line]))


def read_head(uri: str) -> tuple[str, list[str] | None, str | None]:
    """The file's names (none: it has no line), or why it can't be read."""
    try:
        system, path = file_system(uri)
        packed = path.endswith(COMPRESSED)
        with system.open_input_stream(path, compression="detect") as stream:
            return uri, names_of(first_line(stream, packed)), None
    except Exception as e:  # noqa: BLE001 - whatever the file system raises is this file's error
        return uri, None, str(e).strip() or type(e).__name__


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [read_head(x) for x in batch.column("file").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW_SCHEMA.types, strict=True)],
            schema=_ARROW_SCHEMA)


def opens(uri: str) -> bool:
    """Whether this file system is one that ``pyarrow`` knows."""
    try:
        file_system(uri)
    except Exception:  # noqa: BLE001 - an unknown scheme or a missing client library
        return False
    return True


def hadoop_heads(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, list[str] | None, str | None]]:
    """The same through Hadoop's file systems, opened by the driver."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def one(f: str) -> tuple[str, list[str] | None, str | None]:
        try:
            path = jvm.org.apache.hadoop.fs.Path(f)
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
            stream = path.getFileSystem(conf).open(path)
            if codec is not None:
                stream = codec.createInputStream(stream)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            try:
                line = reader.readLine()
                while line is not None and not line.strip():
                    line = reader.readLine()
            finally:
                reader.close()
            return f, names_of(None if line is None else line.removeprefix("﻿")), None
        except Exception as e:  # noqa: BLE001 - as above
            return f, None, str(getattr(e, "java_exception", e)).strip() or type(e).__name__

    with ThreadPoolExecutor(max_workers=HEADER_READ_THREADS) as pool:
        return list(pool.map(one, files))


def file_heads(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file, header, error`` of each file; ``header`` is empty for a file without a line."""
    if not files:
        return spark.createDataFrame([], SCHEMA)
    if not opens(files[0]):
        return spark.createDataFrame(hadoop_heads(spark, files), SCHEMA)
    tasks = -(-len(files) // FILES_PER_TASK)
    listed = spark.createDataFrame(pa.table({"file": pa.array(sorted(files), pa.string())}))
    return listed.repartition(tasks).mapInArrow(_heads, SCHEMA)
