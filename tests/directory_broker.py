"""A directory of Parquet files in place of a message broker.

For places where no broker can be reached, tests above all.  Each topic is a
sub-directory whose files have the column set of Spark's Kafka source.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import storage
from millrace.sources.datasets import KEEP_ALL_FILES
from millrace.sources.topics import Broker

# The columns of Spark's Kafka source that a record carries.
RECORD_SCHEMA = "key BINARY, value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP"


class DirectoryBroker(Broker):
    def __init__(self, root: str):
        super().__init__(options={"root": root}, format="parquet")

    def topic_path(self, topic: str) -> str:
        return f"{self.options['root']}/{topic}"

    def read(self, spark: SparkSession, topics: list[str], start: Mapping[str, Any]) -> DataFrame:
        self._make(spark, topics)
        return super().read(spark, topics, start)

    def read_stream(self, spark: SparkSession, topics: list[str], start: Mapping[str, Any]) -> DataFrame:
        self._make(spark, topics)
        return super().read_stream(spark, topics, start)

    def _make(self, spark: SparkSession, topics: list[str]) -> None:
        """A topic exists from its first mention on, as with a broker that creates topics by itself."""
        for topic in topics:
            storage.make_dir(spark, self.topic_path(topic))

    def _load(self, reader, topics: list[str], start: Mapping[str, Any]) -> DataFrame:
        if start.get("startingOffsets") == "latest":
            raise ValueError("a directory has no latest offset to start from")
        loaded = [
            reader.schema(RECORD_SCHEMA).option("maxFileAge", KEEP_ALL_FILES).parquet(self.topic_path(topic)).withColumn("topic", F.lit(topic))
            for topic in topics
        ]
        return reduce(DataFrame.unionByName, loaded)

    def _bytes(self, records: DataFrame) -> DataFrame:
        return records.select(
            *[F.col(c).cast("binary").alias(c) if c in ("key", "value") else F.col(c) for c in records.columns]
        )

    def write(self, records: DataFrame, topic: str) -> None:
        self._bytes(records).write.mode("append").parquet(self.topic_path(topic))

    def write_stream(self, records: DataFrame, topic: str, writer_options: Mapping[str, Any]):
        # Appended like any batch: the file sink's log would hide what others write to the topic.
        return records.writeStream.foreachBatch(lambda batch, _: self.write(batch, topic)).options(**writer_options)
