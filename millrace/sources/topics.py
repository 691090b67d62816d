"""Topics: reading and writing message logs through a Spark connector."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.rows import keyed_records


@dataclass(frozen=True)
class Broker:
    """Where topics live: a connector name and its options.

    The default connector is Spark's Kafka source and sink; give
    ``{"kafka.bootstrap.servers": "host:port"}`` as options.  For a connector that
    names a topic in an option of its own, ``{topic}`` stands for it there: with
    ``Broker({"path": ".../{topic}"}, "parquet", "key STRING, value STRING")`` topics
    are folders of Spark's Parquet source and sink.  ``schema`` is for sources that
    have to be told theirs.
    """

    options: Mapping[str, str] = field(default_factory=dict)
    format: str = "kafka"
    schema: str | None = None

    def _options(self, topic: str) -> dict[str, str]:
        return {k: v.replace("{topic}", topic) for k, v in self.options.items()}

    def read(self, spark: SparkSession, topics: list[str], start: Mapping[str, Any]) -> DataFrame:
        return self._load(spark.read, topics, start)

    def read_stream(self, spark: SparkSession, topics: list[str], start: Mapping[str, Any]) -> DataFrame:
        return self._load(spark.readStream, topics, start)

    def _load(self, reader, topics: list[str], start: Mapping[str, Any]) -> DataFrame:
        asked = ",".join(topics)
        reader = reader.format(self.format).options(**self._options(asked), **start).option("subscribe", asked)
        return (reader.schema(self.schema) if self.schema else reader).load()

    def write(self, records: DataFrame, topic: str) -> None:
        records.write.format(self.format).mode("append").options(**self._options(topic)).option("topic", topic).save()

    def write_stream(self, records: DataFrame, topic: str, writer_options: Mapping[str, Any]):
        writer = records.writeStream.format(self.format).options(**self._options(topic))
        return writer.option("topic", topic).options(**writer_options)


def start_options(*, earliest: bool = False, latest: bool = False, group_id: str | None = None) -> dict[str, str]:
    """Start position of a new stream; ``latest`` wins when both are asked for.

    With neither, a new stream starts where the connector starts by default.  A
    stream that has a checkpoint always resumes from it, whatever is given here.
    """
    options: dict[str, str] = {}
    if earliest:
        options["startingOffsets"] = "earliest"
    if latest:
        options["startingOffsets"] = "latest"
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def read_topic_stream(
    spark: SparkSession,
    broker: Broker,
    topic: str,
    *,
    earliest: bool = False,
    latest: bool = False,
    group_id: str | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The values of one topic as a stream of text in a column ``value``.

    ``options`` reach the source, for example ``maxOffsetsPerTrigger`` to bound
    one micro-batch over a large backlog.
    """
    start = start_options(earliest=earliest, latest=latest, group_id=group_id)
    return broker.read_stream(spark, [topic], {**start, **(options or {})}).select(F.col("value").cast("string").alias("value"))


def inspect_topics(spark: SparkSession, broker: Broker, topics: list[str], *, stream: bool = False) -> DataFrame:
    """Records of several topics from the earliest offset on, with their position."""
    load = broker.read_stream if stream else broker.read
    return load(spark, list(topics), start_options(earliest=True)).select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def _record_columns(df: DataFrame) -> DataFrame:
    """Only what a record consists of: other columns must not steer the sink."""
    kept = [F.col(c).cast("string").alias(c) for c in ("key", "value") if c in df.columns]
    if "value" not in df.columns:
        raise ValueError("a topic record needs a column named value")
    return df.select(*kept)


def write_topic(df: DataFrame, broker: Broker, topic: str, *, keyed: bool = False) -> None:
    """Append every row's ``value`` (and ``key`` when ``keyed``) to a topic."""
    broker.write(_record_columns(df if keyed else df.select("value")), topic)


def write_topic_stream(
    df: DataFrame,
    broker: Broker,
    topic: str,
    *,
    checkpoint: str,
    trigger: Mapping[str, Any] | None = None,
    name: str | None = None,
    keyed: bool = False,
) -> StreamingQuery:
    """Stream every row's ``value`` to a topic, at least once, resuming from ``checkpoint``."""
    records = _record_columns(df if keyed else df.select("value"))
    writer = broker.write_stream(records, topic, {"checkpointLocation": checkpoint})
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def publish_keyed(df: DataFrame, broker: Broker, topic: str, key: str, *, quoted: bool = False) -> None:
    """Send each row as a record: key = text of one column, value = the whole row as delimited text."""
    write_topic(keyed_records(df, key, quoted=quoted), broker, topic, keyed=True)
