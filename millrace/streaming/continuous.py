"""Continuous loads: keep a table or a topic up to date with a growing dataset.

Every landed file is read once where the projection allows it: row by row, or
by carrying a plain aggregate on from the state of the stream.  Windows that are
partitioned by columns are evaluated again for the values that new files have
there, over a semi-join of the dataset with those values.  Other windows, a
subquery or a distinct aggregate need all rows again, so each trigger that
finds new files evaluates the projection over the whole dataset, and its cost
grows with the dataset.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.functions.rows import encode_rows
from millrace.functions.schema import required_columns
from millrace.operators.constraints import lacks
from millrace.operators.project import named, project
from millrace.plans.shape import PARTS, ROWS, STATE, WHOLE, growth, window_keys
from millrace.sources import storage
from millrace.sources.datasets import dataset_struct, scan_dataset, scan_dataset_stream
from millrace.sources.keyed_table import Commit, KeyedTable
from millrace.sources.topics import Broker, write_topic, write_topic_stream

# Pause in seconds between two rounds of a continuous load.
RELOAD_SECONDS = 2
DEFAULT_TRIGGER = {"processingTime": f"{RELOAD_SECONDS} seconds"}
# Micro-batches after which a load folds the change log, and the age in seconds
# at which it deletes what was replaced: the longest time that a reader or a
# write may take beside it.
COMPACT_EVERY = 60
KEEP_SECONDS = 24 * 3600
# Commits of a table that one micro-batch of its changes takes at most.
COMMITS_A_BATCH = 1000


def _writer_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and dies with the checkpoint, as micro-batch numbers do."""
    path = f"{checkpoint}/writer-name"
    if not storage.exists(spark, path):
        storage.put_text(spark, path, f"stream-{uuid4().hex}")
    return storage.read_text(spark, path)


def _follow(
    spark: SparkSession,
    dataset_path: str,
    schema: Sequence[Mapping[str, Any]],
    exprs: Sequence[str],
    where: str | Column | None,
    source_options: Mapping[str, Any] | None,
    scan: Mapping[str, Any],
) -> tuple[str, DataFrame, Callable[[DataFrame], DataFrame]]:
    """How the projection follows new files, the stream that drives it, and what a micro-batch of it stands for."""
    # An empty frame is enough to analyze the projection; no file is listed for it.
    empty = spark.createDataFrame([], dataset_struct(schema, corrupt=scan.get("corrupt", False), zone_free=scan.get("zone_free", False)))
    projected = project(empty, exprs, where)
    how = growth(projected)
    options = dict(source_options or {})
    if how == WHOLE:
        # The new files only say that there is work; taking them in portions
        # would repeat the whole evaluation for each.
        portions = [k for k in options if k.lower() in ("maxfilespertrigger", "maxbytespertrigger")]
        if portions:
            raise ValueError(f"the projection needs the whole dataset in each round: leave out {', '.join(portions)}")
    files = scan_dataset_stream(spark, dataset_path, schema, options=options, **scan)
    keys = window_keys(projected) if how == PARTS else []

    def rows_of(batch: DataFrame) -> DataFrame:
        if how in (ROWS, STATE):
            return batch
        rows = scan_dataset(batch.sparkSession, dataset_path, schema, **scan)
        if how == PARTS:
            touched = batch.select(*[named(k).alias(f"_t{i}") for i, k in enumerate(keys)]).distinct()
            # NULLs make one partition.
            same = reduce(and_, [named(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)])
            rows = rows.join(touched, same, "left_semi")
        return project(rows, exprs, where)

    return how, project(files, exprs, where) if how in (ROWS, STATE) else files, rows_of


def _start(
    writer: DataStreamWriter, how: str, checkpoint: str, trigger: Mapping[str, Any] | None, name: str | None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))
    if how == STATE:
        writer = writer.outputMode("update")
    if name:
        writer = writer.queryName(name)
    return writer.start()


def stream_to_table(
    spark: SparkSession,
    dataset_path: str,
    schema: Sequence[Mapping[str, Any]],
    table_path: str,
    exprs: Sequence[str],
    *,
    checkpoint: str,
    where: str | Column | None = None,
    trigger: Mapping[str, Any] | None = None,
    source_options: Mapping[str, Any] | None = None,
    scan_options: Mapping[str, Any] | None = None,
    compact_every: int | None = COMPACT_EVERY,
    keep_seconds: float = KEEP_SECONDS,
    quarantine: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Upsert the projection of every new file into a keyed table.

    A failed constraint fails its micro-batch and stops the query; with a folder for
    ``quarantine``, rows that lack a required column go there instead (see
    :func:`quarantined`) and the others are loaded.  A replayed
    micro-batch is recognised and not written twice.  The change log is folded
    after ``compact_every`` micro-batches (None: never), and what was replaced
    more than ``keep_seconds`` ago is deleted.  A projection with windows, or of
    the whole dataset, writes only the rows that differ from the table's.
    """
    how, stream, rows_of = _follow(spark, dataset_path, schema, exprs, where, source_options, dict(scan_options or {}))
    writer_name = _writer_name(spark, checkpoint)

    def load(batch: DataFrame, epoch: int) -> None:
        table = KeyedTable.open(batch.sparkSession, table_path)
        rows, changed_only = rows_of(batch), how in (PARTS, WHOLE)
        if quarantine is None:
            table.upsert(rows, writer=writer_name, epoch=epoch, changed_only=changed_only)
        else:
            _upsert_split(table, rows, quarantine, writer_name, epoch, changed_only)
        if compact_every and (epoch + 1) % compact_every == 0:
            table.compact()
            table.vacuum(older_than=keep_seconds)

    return _start(stream.writeStream.foreachBatch(load), how, checkpoint, trigger, name)


def _upsert_split(table: KeyedTable, rows: DataFrame, quarantine: str, writer: str, epoch: int, changed_only: bool) -> None:
    """Upsert the rows that have all required columns, and write the others to a folder of the micro-batch.

    They are counted in the pass that loads the rest, so a micro-batch without any is read once.
    """
    have = {c.lower() for c in rows.columns}
    lacking = lacks(c for c in {*required_columns(table.schema), *table.sequence_by} if c.lower() in have)
    seen = Observation()
    observed = rows.observe(seen, F.count_if(lacking).alias("lacking"))
    done = table.upsert(observed.where(~lacking), writer=writer, epoch=epoch, changed_only=changed_only)
    # A micro-batch that was committed before a failure is not counted again.
    if not done or seen.get["lacking"]:
        bad = rows.where(lacking)
        bad.write.mode("overwrite").parquet(f"{quarantine}/load={writer}/batch={epoch}")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Rows that continuous loads kept out of their tables, as projected, with ``load`` (the writer) and ``batch``.

    A replayed micro-batch replaces its rows.  A projection that is evaluated again for a partition or the whole dataset
    gives its violating rows again each time.  Loads that share a folder should have the same columns; without any
    quarantined row there is nothing to read, and the frame is empty and has only these two columns.
    """
    if not storage.exists(spark, path):
        return spark.createDataFrame([], "load string, batch int")
    return spark.read.option("mergeSchema", "true").parquet(path)


def stream_to_topic(
    spark: SparkSession,
    dataset_path: str,
    schema: Sequence[Mapping[str, Any]],
    broker: Broker,
    topic: str,
    exprs: Sequence[str] = (),
    *,
    checkpoint: str,
    where: str | Column | None = None,
    quoted: bool = False,
    trigger: Mapping[str, Any] | None = None,
    source_options: Mapping[str, Any] | None = None,
    scan_options: Mapping[str, Any] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Send the encoded projection of every new file to a topic, at least once.

    A projection that is not row-local is sent anew for each round: with windows,
    for the partitions that new files touch, else in full; an aggregate is a
    single row.
    """
    how, stream, rows_of = _follow(spark, dataset_path, schema, exprs, where, source_options, dict(scan_options or {}))
    if how == ROWS:
        values = encode_rows(stream, quoted=quoted)
        return write_topic_stream(
            values, broker, topic, checkpoint=checkpoint, trigger=trigger or DEFAULT_TRIGGER, name=name
        )

    def send(batch: DataFrame, epoch: int) -> None:
        write_topic(encode_rows(rows_of(batch), quoted=quoted), broker, topic)

    return _start(stream.writeStream.foreachBatch(send), how, checkpoint, trigger, name)


def stream_changes(
    spark: SparkSession,
    table_path: str,
    send: Callable[[DataFrame, int], None],
    *,
    checkpoint: str,
    trigger: Mapping[str, Any] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Call ``send`` with the rows of a keyed table that changed, micro-batch by micro-batch.

    The first micro-batches cover the table as it stands.  A micro-batch takes the
    commits since the last one, and has the rows that are now different or new, as
    they are after its last commit, each once; nothing is sent for a write that left
    every row as it was.  What a compaction has folded meanwhile is compared
    with nothing and sent as it stands, so a row may come again, but none is left out.
    A micro-batch is repeated after a failure.  A feed may lag behind its table for as
    long as the table keeps its log (``keep_seconds`` of continuous loads).
    """
    storage.make_dir(spark, f"{table_path}/commits")
    commits = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", COMMITS_A_BATCH)
    commits = commits.load(f"{table_path}/commits").select(F.col("_metadata.file_name").alias("marker"), "value")

    def feed(batch: DataFrame, epoch: int) -> None:
        # One small row per commit.
        found = [Commit(int(r["marker"]), *json.loads(r["value"])) for r in batch.collect()]
        if found:
            send(KeyedTable.open(batch.sparkSession, table_path).changes(found), epoch)

    return _start(commits.writeStream.foreachBatch(feed), ROWS, checkpoint, trigger, name)
