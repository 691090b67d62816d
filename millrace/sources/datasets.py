"""Datasets: directories of headerless delimited text, scanned under a declared schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.rows import QUOTED, unescaped
from millrace.functions.schema import to_struct
from millrace.sources import storage

CORRUPT = "_corrupt_record"
# A file stream passes over files that are older than this by the newest file it
# has seen.  A century keeps them all, as the batch scan does.
KEEP_ALL_FILES = "36500d"
# In a folder that a stream fills, a micro-batch's files are all newer than those
# of the one before, so a file can't be late by more than the clocks are apart:
# what is older than this by the newest file read need not be remembered.
KEEP_LANDED_FILES = "2d"
# Fixed value: where Spark's file sink logs the micro-batches it has landed.
SINK_LOG = "_spark_metadata"
# Folders of the sources that share a dataset; the rest of the name is the source's.
SOURCE_FOLDER = "source="


def dataset_struct(
    schema: Iterable[Mapping[str, Any]] | T.StructType, *, corrupt: bool = False, zone_free: bool = False
) -> T.StructType:
    """The columns that a scan of a dataset returns.

    All are nullable: text can always lack a value.  A scan through a sink's
    log would otherwise trust NOT NULL flags and fail on such a line.
    """
    struct = schema if isinstance(schema, T.StructType) else to_struct(schema)
    fields = [T.StructField(f.name, f.dataType) for f in struct]
    if zone_free:
        free = T.TimestampNTZType()
        fields = [T.StructField(f.name, free) if isinstance(f.dataType, T.TimestampType) else f for f in fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())] if corrupt else fields)


def _csv(reader, schema, mode: str, quoted: bool, corrupt: bool, zone_free: bool, bucket: str | None = None):
    struct = dataset_struct(schema, corrupt=corrupt, zone_free=zone_free)
    names = struct.names
    reader = reader.schema(struct).option("header", "false").option("sep", ",").option("mode", mode)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if quoted:
        reader = reader.options(**QUOTED)
    # A directory filled by a streaming file sink carries that sink's log of
    # committed files.  Spark honours it when given the directory itself, as
    # here and not as a glob, so files of failed attempts stay unread.
    reader = reader.option("recursiveFileLookup", str(not bucket).lower())
    return reader, names


def landed_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that a scan of ``path`` unites: itself, or one per source that lands there, each with its sink's log."""
    found = storage.names(spark, path)
    sources = [f"{path}/{n}" for n in found if n.startswith(SOURCE_FOLDER)]
    return [path, *sources] if SINK_LOG in found or not sources else sources


def _declared(df: DataFrame, names: list[str], bucket: str | None, quoted: bool) -> DataFrame:
    def wanted(name: str) -> Column:
        column = F.col(f"`{name}`")
        is_text = quoted and name != CORRUPT and df.schema[name].dataType == T.StringType()
        return unescaped(column).alias(name) if is_text else column

    columns = [wanted(n) for n in names]
    return df.select(*columns, F.col(f"`{bucket}`").cast("string").alias(bucket)) if bucket else df.select(*columns)


def _united(folders: list[str], scan: Callable[[str], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [scan(folder) for folder in folders])


def scan_dataset(
    spark: SparkSession,
    path: str,
    schema: Iterable[Mapping[str, Any]] | T.StructType,
    *,
    mode: str = "PERMISSIVE",
    quoted: bool = False,
    corrupt: bool = False,
    zone_free: bool = False,
    bucket: str | None = None,
) -> DataFrame:
    """Typed batch scan of every text file below ``path``.

    An empty field is NULL, a value that does not parse is NULL, a missing
    tail is NULL and an extra tail is dropped.  Names starting with ``.`` or
    ``_`` are skipped.  ``corrupt=True`` adds ``_corrupt_record``.  A
    ``timestamp`` is read in the session's zone; ``zone_free=True`` keeps it as
    written, as a ``timestamp_ntz``.  ``bucket``
    names the landing directory column and exposes it, so that a filter on it
    leaves whole directories unread.  Sources that land in folders of their own
    below ``path`` are united, without a shuffle.
    """

    def scan(folder: str) -> DataFrame:
        reader, names = _csv(spark.read, schema, mode, quoted, corrupt, zone_free, bucket)
        return _declared(reader.csv(folder), names, bucket, quoted)

    return _united(landed_folders(spark, path), scan)


def scan_dataset_stream(
    spark: SparkSession,
    path: str,
    schema: Iterable[Mapping[str, Any]] | T.StructType,
    *,
    mode: str = "PERMISSIVE",
    quoted: bool = False,
    corrupt: bool = False,
    zone_free: bool = False,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The same scan as a stream that reads each new file once.

    ``options`` reach the file source, for example ``maxBytesPerTrigger`` or
    ``maxFilesPerTrigger`` to bound one micro-batch over a large backlog.  No
    file is passed over for its age.  Of a folder that ``land_stream`` fills only
    the files of the last two days read are remembered, since none comes late there,
    whatever hour its lines are of; of any other folder every file is, unless
    ``maxFileAge`` says that older ones never come late.  The dataset's sources are those there when the stream is made: after one is added,
    follow the dataset under a new checkpoint.
    """

    def scan(folder: str) -> DataFrame:
        reader, names = _csv(spark.readStream, schema, mode, quoted, corrupt, zone_free)
        is_landed = storage.exists(spark, f"{folder}/{SINK_LOG}")
        reader = reader.option("maxFileAge", KEEP_LANDED_FILES if is_landed else KEEP_ALL_FILES)
        return _declared(reader.options(**(options or {})).csv(folder), names, None, quoted)

    return _united(landed_folders(spark, path), scan)
