"""Landing a stream of text values in a directory of text files."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources import storage
from millrace.sources.datasets import SINK_LOG, SOURCE_FOLDER

# Name format of the hourly directories, and the default age in
# seconds at which a landing file is closed.
BUCKET_FORMAT = "yyyy-MM-dd--HH"
ROLL_SECONDS = 15


class LandingConflictError(ValueError):
    """The directory was filled under another checkpoint, whose micro-batch numbers would hide the new ones."""


def _claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Note which checkpoint fills a directory, and refuse any other.

    The sink passes over a micro-batch whose number its log has.  A second
    checkpoint, or a first one that was lost, counts from zero again.
    """
    note, asked = f"{path}/_landed_under", checkpoint.rstrip("/")
    landed = storage.exists(spark, f"{path}/{SINK_LOG}")
    if storage.exists(spark, note):
        held = storage.read_text(spark, note)
    else:
        storage.put_text(spark, note, asked)
        held = asked
    if held != asked:
        raise LandingConflictError(f"{path} is filled under checkpoint {held}, not {asked}: land in a directory of its own")
    if landed and not storage.exists(spark, f"{checkpoint}/metadata"):
        raise LandingConflictError(f"{path} was filled under a checkpoint that {checkpoint} no longer holds")


def _source_folder(spark: SparkSession, path: str, source: str) -> str:
    """Where a source lands that shares its dataset with others."""
    if not re.fullmatch(r"[\w.-]+", source):
        raise ValueError(f"a source's name has letters, digits, '_', '.' and '-' only: {source!r}")
    found = storage.names(spark, path)
    loose = [n for n in found if n[0] not in "._" and not n.startswith(SOURCE_FOLDER)]
    if loose and SINK_LOG not in found:
        # A scan would have to list these beside folders that must be read by their logs.
        raise LandingConflictError(f"{path} has files that no stream landed: land sources in a directory of their own")
    return f"{path}/{SOURCE_FOLDER}{source}"


def bucket_of(moment: Column, bucket_format: str = BUCKET_FORMAT) -> Column:
    """Name of the landing directory for a time; hourly by default."""
    return F.date_format(moment, bucket_format)


def bucket_column(names: list[str]) -> str:
    """A directory column name that no declared column uses."""
    taken = {n.lower() for n in names}
    name = "bucket"
    while name in taken:
        name += "_"
    return name


def land_stream(
    df: DataFrame,
    path: str,
    *,
    checkpoint: str,
    source: str | None = None,
    time: Column | None = None,
    bucket: str = "bucket",
    bucket_format: str = BUCKET_FORMAT,
    files_per_bucket: int | None = None,
    trigger: Mapping[str, Any] | None = None,
    max_records_per_file: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append each row's ``value`` as one line below ``path/<bucket>=<hour>/``.

    The hour is that of processing, or of ``time`` where a column is given.
    A file is closed at the end of its micro-batch, so the ``trigger`` interval
    sets the age at which files roll (15 s by default); ``max_records_per_file``
    bounds their size.  There is no idle timer: an idle stream has no open file.
    Files count once the sink's log lists them, which makes landing exactly
    once for scans of ``path``.  A directory is filled under one checkpoint:
    another one is refused with :class:`LandingConflictError`.

    Streams that land in one dataset side by side are told apart by ``source``:
    each has a folder, a log and a checkpoint of its own below ``path``, and
    scans of ``path`` unite them with what was landed without a source.

    Each task writes its own file in every directory it has lines for.  That is
    one directory at a time for processing time, but a backlog spread by
    ``time`` meets many: ``files_per_bucket`` then shuffles the lines so that
    one directory is written by that many tasks, which also splits an hour that
    holds most of the lines.
    """
    if source is not None:
        path = _source_folder(df.sparkSession, path, source)
    _claim(df.sparkSession, path, checkpoint)
    moment = F.current_timestamp() if time is None else time
    lines = df.select(F.col("value"), bucket_of(moment, bucket_format).alias(bucket))
    if files_per_bucket:
        # Spread by content and input partition, not at random, so that a lost
        # task is redone with the same lines; many copies of one line come from
        # several input partitions and spread as well.
        part = F.pmod(F.xxhash64("value", F.spark_partition_id()), F.lit(files_per_bucket))
        lines = lines.withColumn("__part", part).repartition(F.col(f"`{bucket}`"), F.col("__part")).drop("__part")
    writer = (
        lines.writeStream.format("text")
        .partitionBy(bucket)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": f"{ROLL_SECONDS} seconds"}))
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if name:
        writer = writer.queryName(name)
    return writer.start()
