"""The dataflows: topic to dataset, dataset to table, and both to topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.rows import encode_rows
from millrace.operators.project import project
from millrace.sources.datasets import scan_dataset
from millrace.sources.keyed_table import KeyedTable, upsert_table
from millrace.sources.topics import Broker, read_topic_stream, write_topic, write_topic_stream
from millrace.streaming.continuous import stream_changes, stream_to_table, stream_to_topic
from millrace.streaming.landing import land_stream


def topic_to_dataset(
    spark: SparkSession,
    broker: Broker,
    topic: str,
    path: str,
    *,
    checkpoint: str,
    start: Mapping[str, Any] | None = None,
    **landing: Any,
) -> StreamingQuery:
    """Land a topic's values as text files, one line each."""
    return land_stream(read_topic_stream(spark, broker, topic, **(start or {})), path, checkpoint=checkpoint, **landing)


def topic_to_topic(
    spark: SparkSession,
    broker: Broker,
    source: str,
    target: str,
    *,
    checkpoint: str,
    target_broker: Broker | None = None,
    start: Mapping[str, Any] | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Copy a topic's values unchanged; keys are not carried over."""
    values = read_topic_stream(spark, broker, source, **(start or {}))
    return write_topic_stream(values, target_broker or broker, target, checkpoint=checkpoint, trigger=trigger)


def dataset_to_table(
    spark: SparkSession,
    dataset_path: str,
    schema: Sequence[Mapping[str, Any]],
    table_path: str,
    exprs: Sequence[str],
    *,
    where: str | Column | None = None,
    continuous: bool = False,
    checkpoint: str | None = None,
    scan_options: Mapping[str, Any] | None = None,
    **options: Any,
) -> StreamingQuery | bool:
    """Load the projection of a dataset into a keyed table, once or continuously.

    A table load needs select expressions; ``["*"]`` takes all columns.
    """
    need_expressions(exprs)
    if continuous:
        return stream_to_table(
            spark,
            dataset_path,
            schema,
            table_path,
            exprs,
            checkpoint=_needed(checkpoint),
            where=where,
            scan_options=scan_options,
            **options,
        )
    rows = scan_dataset(spark, dataset_path, schema, **(scan_options or {}))
    return upsert_table(spark, table_path, project(rows, exprs, where), **options)


def dataset_to_topic(
    spark: SparkSession,
    dataset_path: str,
    schema: Sequence[Mapping[str, Any]],
    broker: Broker,
    topic: str,
    exprs: Sequence[str] = (),
    *,
    where: str | Column | None = None,
    quoted: bool = False,
    continuous: bool = False,
    checkpoint: str | None = None,
    scan_options: Mapping[str, Any] | None = None,
    **options: Any,
) -> StreamingQuery | None:
    """Send the encoded projection of a dataset to a topic, once or continuously."""
    if continuous:
        return stream_to_topic(
            spark,
            dataset_path,
            schema,
            broker,
            topic,
            exprs,
            checkpoint=_needed(checkpoint),
            where=where,
            quoted=quoted,
            scan_options=scan_options,
            **options,
        )
    rows = scan_dataset(spark, dataset_path, schema, **(scan_options or {}))
    write_topic(encode_rows(project(rows, exprs, where), quoted=quoted), broker, topic, **options)
    return None


def table_to_topic(
    spark: SparkSession,
    table_path: str,
    broker: Broker,
    topic: str,
    *,
    where: str | Column | Sequence[str | Column] | None = None,
    quoted: bool = False,
    continuous: bool = False,
    checkpoint: str | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery | None:
    """Send the rows of a keyed table, encoded, to a topic: all of them once, or continuously those that change.

    ``where`` is a condition or a list of them.  Those on key columns alone
    reach the scans; the others see the merged rows.  A continuous flow sends
    the table as it stands first, and from then on every row that is new or
    different after the latest writes, if it meets the conditions; at least once.
    """
    conditions = [where] if isinstance(where, (str, Column)) else list(where or ())

    def send(rows: DataFrame, epoch: int = 0) -> None:
        for condition in conditions:
            rows = rows.where(condition)
        write_topic(encode_rows(rows, quoted=quoted), broker, topic)

    if continuous:
        return stream_changes(spark, table_path, send, checkpoint=_needed(checkpoint), trigger=trigger)
    table = KeyedTable.open(spark, table_path)
    on_keys = [c for c in conditions if table.is_on_keys(c)]
    conditions = [c for c in conditions if not any(c is k for k in on_keys)]
    send(table.read(on_keys))
    return None


def need_expressions(exprs: Sequence[str]) -> None:
    if not exprs:
        raise ValueError("a table load needs at least one select expression")


def _needed(checkpoint: str | None) -> str:
    if not checkpoint:
        raise ValueError("a continuous flow needs a checkpoint directory")
    return checkpoint
