import os

import pytest
from pyspark.sql import functions as F

from millrace.functions.rows import encode_rows
from millrace.functions.schema import from_struct
from millrace.plans import flows, shape
from millrace.sources import datasets, topics
from millrace.sources.datasets import scan_dataset, scan_dataset_stream
from millrace.sources.keyed_table import KeyedTable, scan_table
from millrace.streaming import continuous
from millrace.streaming.landing import LandingConflictError, bucket_column
from tests.conftest import rows
from tests.directory_broker import DirectoryBroker

ONCE = {"availableNow": True}
SCHEMA = [
    {"column_name": "timestamp", "column_type": "biginteger", "nullable": False, "primary_key": True},
    {"column_name": "my_column", "column_type": "string"},
    {"column_name": "name", "column_type": "string"},
]
TABLE = [
    {"column_name": "id", "column_type": "biginteger", "nullable": False, "primary_key": True},
    {"column_name": "my_column", "column_type": "string"},
]


def drop(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def values(spark, broker, topic):
    return sorted(r.value for r in topics.inspect_topics(spark, broker, [topic]).collect())


@pytest.fixture
def broker(work):
    return DirectoryBroker(f"{work}/topics")


class Recorder:
    """Stands in for a reader or writer and records what it is asked for."""

    def __init__(self, df):
        self.df, self.asked = df, {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, name, value):
        self.asked[name] = value
        return self

    def options(self, **given):
        self.asked.update(given)
        return self

    def load(self):
        return self.df


def test_kafka_options(spark):
    broker = topics.Broker({"kafka.bootstrap.servers": "h:9092"})
    reader = Recorder(spark.range(0))
    start = topics.start_options(earliest=True, latest=True, group_id="g")
    broker._load(reader, ["a", "b"], start)
    assert reader.asked == {
        "format": "kafka",
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
    }
    assert topics.start_options() == {}
    assert topics.start_options(earliest=True) == {"startingOffsets": "earliest"}


def test_only_key_and_value_reach_the_sink(spark, broker):
    df = spark.createDataFrame([("k", "v", 3, "h")], "key string, value string, partition int, headers string")
    assert topics._record_columns(df).columns == ["key", "value"]
    with pytest.raises(ValueError):
        topics._record_columns(df.drop("value"))
    topics.write_topic(df, broker, "t")
    record = topics.inspect_topics(spark, broker, ["t"]).first()
    assert (record.key, record.value, record.partition) == (None, "v", None)


def test_publish_keyed(spark, broker):
    df = spark.createDataFrame([(17, "u-my-value", "default_name")], "timestamp long, my_column string, name string")
    topics.publish_keyed(df, broker, "t", "timestamp")
    record = topics.inspect_topics(spark, broker, ["t"]).first()
    assert (record.topic, record.key, record.value) == ("t", "17", "17,u-my-value,default_name")


def test_inspect_several_topics_as_a_stream(spark, broker, work):
    for topic in ("a", "b"):
        topics.write_topic(spark.createDataFrame([(topic, f"{topic},1")], "key string, value string"), broker, topic, keyed=True)
    stream = topics.inspect_topics(spark, broker, ["a", "b"], stream=True)
    assert stream.isStreaming and stream.columns == ["topic", "partition", "offset", "key", "value"]
    writer = stream.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/cp")
    writer.trigger(**ONCE).start().awaitTermination()
    assert rows(spark.read.parquet(f"{work}/out")) == rows(topics.inspect_topics(spark, broker, ["a", "b"]))
    with pytest.raises(ValueError):
        topics.read_topic_stream(spark, broker, "a", latest=True)


def test_landing_resumes_without_repeating(spark, broker, work):
    def run():
        flows.topic_to_dataset(
            spark, broker, "t", f"{work}/ds", checkpoint=f"{work}/cp", start={"earliest": True}, trigger=ONCE
        ).awaitTermination()
        return rows(scan_dataset(spark, f"{work}/ds", SCHEMA))

    topics.write_topic(spark.createDataFrame([("1,a,x",), ("2,,y",)], "value string"), broker, "t")
    assert run() == [(1, "a", "x"), (2, None, "y")]
    assert run() == [(1, "a", "x"), (2, None, "y")]
    topics.write_topic(spark.createDataFrame([("bad,c",)], "value string"), broker, "t")
    assert run() == [(1, "a", "x"), (2, None, "y"), (None, "c", None)]
    assert all(n.startswith(("bucket=", "_", ".")) for n in os.listdir(f"{work}/ds"))


def test_files_of_failed_attempts_are_not_scanned(spark, broker, work):
    topics.write_topic(spark.createDataFrame([("1,a,x",)], "value string"), broker, "t")
    flows.topic_to_dataset(
        spark, broker, "t", f"{work}/ds", checkpoint=f"{work}/cp", start={"earliest": True}, trigger=ONCE
    ).awaitTermination()
    folder = next(n for n in os.listdir(f"{work}/ds") if n.startswith("bucket="))
    drop(f"{work}/ds/{folder}", "part-99999-uncommitted.txt", "1,a,x\n")
    assert rows(scan_dataset(spark, f"{work}/ds", SCHEMA)) == [(1, "a", "x")]


def test_landing_splits_a_bucket_of_copies(spark, broker, work):
    # Partitions this small would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    same = spark.range(0, 4000, 1, 8).select(F.lit("1,2024-01-01 00:00:00").alias("value"))
    topics.write_topic(same, broker, "t")
    flows.topic_to_dataset(
        spark,
        broker,
        "t",
        f"{work}/ds",
        checkpoint=f"{work}/cp",
        start={"earliest": True},
        trigger=ONCE,
        time=F.to_timestamp(F.split("value", ",")[1]),
        files_per_bucket=4,
    ).awaitTermination()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [n for n in os.listdir(f"{work}/ds/bucket=2024-01-01--00") if n.endswith(".txt")]
    assert 1 < len(files) <= 4
    assert spark.read.text(f"{work}/ds").count() == 4000


def test_max_records_per_file(spark, broker, work):
    topics.write_topic(spark.range(0, 100, 1, 1).selectExpr("CAST(id AS STRING) AS value"), broker, "t")
    flows.topic_to_dataset(
        spark, broker, "t", f"{work}/ds", checkpoint=f"{work}/cp", trigger=ONCE, max_records_per_file=30
    ).awaitTermination()
    files = [n for _, _, names in os.walk(f"{work}/ds") for n in names if n.startswith("part-") and n.endswith(".txt")]
    assert len(files) == 4


def test_bucket_column_avoids_declared_names():
    assert bucket_column(["a"]) == "bucket"
    assert bucket_column(["Bucket", "bucket_"]) == "bucket__"


def test_topic_copy_drops_keys(spark, broker, work):
    data = spark.createDataFrame([("k", "1,a"), ("k", "2,b")], "key string, value string")
    topics.write_topic(data, broker, "a", keyed=True)
    for _ in range(2):
        flows.topic_to_topic(
            spark, broker, "a", "b", checkpoint=f"{work}/cp", start={"earliest": True}, trigger=ONCE
        ).awaitTermination()
    assert values(spark, broker, "b") == ["1,a", "2,b"]
    assert {r.key for r in topics.inspect_topics(spark, broker, ["b"]).collect()} == {None}


def test_dataset_to_table_once(spark, work):
    drop(f"{work}/ds", "p0", "1,a,x\n2,,y\n1,b,z\n")
    KeyedTable.create(spark, f"{work}/t", TABLE)
    flows.dataset_to_table(spark, f"{work}/ds", SCHEMA, f"{work}/t", ["timestamp AS id", "my_column"], where="name <> 'z'")
    assert rows(scan_table(spark, f"{work}/t")) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        flows.dataset_to_table(spark, f"{work}/ds", SCHEMA, f"{work}/t", ["*"], continuous=True)


def run_table(spark, work, exprs, **options):
    query = flows.dataset_to_table(
        spark,
        f"{work}/ds",
        SCHEMA,
        f"{work}/t",
        exprs,
        continuous=True,
        checkpoint=f"{work}/cp",
        trigger=ONCE,
        **options,
    )
    query.awaitTermination()
    return query


def test_continuous_table_reads_each_file_once(spark, work):
    KeyedTable.create(spark, f"{work}/t", TABLE)
    exprs = ["timestamp AS id", "my_column"]
    drop(f"{work}/ds", "p0", "1,a,x\n2,b,y\n")
    run_table(spark, work, exprs)
    drop(f"{work}/ds", "p1", "2,c,y\n3,d,y\n")
    query = run_table(spark, work, exprs)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    before = os.listdir(f"{work}/t/commits")
    run_table(spark, work, exprs)
    assert os.listdir(f"{work}/t/commits") == before
    assert rows(scan_table(spark, f"{work}/t")) == [(1, "a"), (2, "c"), (3, "d")]


AGGREGATES = [
    # count(*) goes on from the stream's state and reads the new rows alone.
    ("count(*)", [2, 3, 5], [2, 1, 2]),
    # count(DISTINCT) scans the dataset again and leaves the stream's rows unread.
    ("count(DISTINCT my_column)", [2, 2, 4], [0, 0, 0]),
]


@pytest.mark.parametrize("aggregate,expected,new_rows", AGGREGATES)
def test_continuous_aggregate_sees_all_history(spark, work, aggregate, expected, new_rows):
    schema = [
        {"column_name": "id", "column_type": "integer", "nullable": False, "primary_key": True},
        {"column_name": "n", "column_type": "biginteger"},
    ]
    KeyedTable.create(spark, f"{work}/t", schema)
    for number, text in enumerate(["1,a,x\n2,b,y\n", "3,b,z\n", "4,d,w\n5,e,v\n"]):
        drop(f"{work}/ds", f"p{number}", text)
        query = run_table(spark, work, ["1 AS id", f"{aggregate} AS n"])
        assert sum(p["numInputRows"] for p in query.recentProgress) == new_rows[number]
        assert rows(scan_table(spark, f"{work}/t")) == [(1, expected[number])]


def test_continuous_window_sees_all_history(spark, work):
    schema = [*TABLE[:1], {"column_name": "rank", "column_type": "integer"}]
    KeyedTable.create(spark, f"{work}/t", schema)
    for number, text in enumerate(["1,a,x\n3,a,y\n", "2,a,z\n"]):
        drop(f"{work}/ds", f"p{number}", text)
        drop(f"{work}/ds", f"q{number}", "")
        exprs = ["timestamp AS id", "row_number() OVER (ORDER BY timestamp) AS rank"]
        query = run_table(spark, work, exprs)
        # Two new files, one evaluation.
        assert len([p for p in query.recentProgress if "addBatch" in p["durationMs"]]) == 1
    assert rows(scan_table(spark, f"{work}/t")) == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(ValueError, match="maxFilesPerTrigger"):
        run_table(spark, work, exprs, source_options={"maxFilesPerTrigger": 1})


def test_late_files_are_read(spark, work):
    KeyedTable.create(spark, f"{work}/t", TABLE)
    drop(f"{work}/ds", "p0", "1,a,x\n")
    run_table(spark, work, ["timestamp AS id", "my_column"])
    drop(f"{work}/ds", "p1", "2,b,y\n")
    os.utime(f"{work}/ds/p1", (1_000_000_000, 1_000_000_000))
    run_table(spark, work, ["timestamp AS id", "my_column"])
    assert rows(scan_table(spark, f"{work}/t")) == [(1, "a"), (2, "b")]


def test_second_checkpoint_may_not_land_in_a_directory(spark, broker, work):
    def land(topic, checkpoint):
        flows.topic_to_dataset(spark, broker, topic, f"{work}/ds", checkpoint=checkpoint, trigger=ONCE).awaitTermination()

    for topic in ("a", "b"):
        topics.write_topic(spark.createDataFrame([(f"1,{topic},x",)], "value string"), broker, topic)
    land("a", f"{work}/cp")
    with pytest.raises(LandingConflictError, match="cp2"):
        land("b", f"{work}/cp2")
    os.rename(f"{work}/cp", f"{work}/lost")
    with pytest.raises(LandingConflictError, match="no longer"):
        land("a", f"{work}/cp")
    assert rows(scan_dataset(spark, f"{work}/ds", SCHEMA)) == [(1, "a", "x")]


def test_sources_share_a_dataset(spark, broker, work):
    def land(topic, value, source=None):
        topics.write_topic(spark.createDataFrame([(value,)], "value string"), broker, topic)
        where = {"checkpoint": f"{work}/cp-{topic}", "source": source, "trigger": ONCE}
        flows.topic_to_dataset(spark, broker, topic, f"{work}/ds", **where).awaitTermination()

    def follow(checkpoint):
        seen = []
        stream = scan_dataset_stream(spark, f"{work}/ds", SCHEMA).writeStream.foreachBatch(lambda df, _: seen.extend(rows(df)))
        stream.option("checkpointLocation", f"{work}/{checkpoint}").trigger(**ONCE).start().awaitTermination()
        return sorted(seen)

    land("a", "1,a,x")
    land("b", "2,b,y", "b")
    land("c", "3,c,z", "c")
    everything = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]
    assert rows(scan_dataset(spark, f"{work}/ds", SCHEMA)) == everything
    assert follow("follow") == everything
    # A file that no log lists, as a failed attempt leaves it, is no part of the dataset.
    bucket = next(n for n in os.listdir(f"{work}/ds/source=b") if n.startswith("bucket="))
    drop(f"{work}/ds/source=b/{bucket}", "part-lost", "9,lost,lost\n")
    land("b", "4,b,y", "b")
    assert rows(scan_dataset(spark, f"{work}/ds", SCHEMA)) == [*everything, (4, "b", "y")]
    assert follow("follow") == [(4, "b", "y")]
    buckets = scan_dataset(spark, f"{work}/ds", SCHEMA, bucket="bucket")
    assert buckets.where("bucket >= '2000'").count() == 4 and buckets.where("bucket < '2000'").count() == 0


def test_closed_hours_are_not_remembered(spark, broker, work, monkeypatch):
    """What a stream remembers of a landed folder is bounded by age, not by the files that it has read; none is lost."""
    monkeypatch.setattr(datasets, "KEEP_LANDED_FILES", "1ms")
    for number in range(4):
        topics.write_topic(spark.createDataFrame([(f"{number},a,x",)], "value string"), broker, "a")
        flows.topic_to_dataset(spark, broker, "a", f"{work}/ds", checkpoint=f"{work}/cp", trigger=ONCE).awaitTermination()
        seen = []
        stream = scan_dataset_stream(spark, f"{work}/ds", SCHEMA).writeStream.foreachBatch(lambda df, _: seen.extend(rows(df)))
        query = stream.option("checkpointLocation", f"{work}/follow").trigger(**ONCE).start()
        query.awaitTermination()
        assert seen == [(number, "a", "x")]
        assert query._jsq.streamingQuery().sources().head().seenFiles().size() == 1


def test_sources_that_cannot_share(spark, broker, work):
    topics.write_topic(spark.createDataFrame([("1,a,x",)], "value string"), broker, "a")
    drop(f"{work}/ds", "p0", "1,a,x\n")
    with pytest.raises(LandingConflictError, match="no stream landed"):
        flows.topic_to_dataset(spark, broker, "a", f"{work}/ds", checkpoint=f"{work}/cp", source="a")
    with pytest.raises(ValueError, match="name"):
        flows.topic_to_dataset(spark, broker, "a", f"{work}/new", checkpoint=f"{work}/cp", source="../a")


def test_topics_take_batches_and_streams(spark, broker, work):
    for topic in ("a", "b", "c"):
        topics.write_topic(spark.createDataFrame([(topic,)], "value string"), broker, topic)
    for topic in ("a", "b"):
        flows.topic_to_topic(spark, broker, topic, "c", checkpoint=f"{work}/{topic}", trigger=ONCE).awaitTermination()
    topics.write_topic(spark.createDataFrame([("d",)], "value string"), broker, "c")
    assert values(spark, broker, "c") == ["a", "b", "c", "d"]


def test_replayed_batch_changes_nothing(spark, work):
    KeyedTable.create(spark, f"{work}/t", TABLE)
    exprs = ["timestamp AS id", "my_column"]
    drop(f"{work}/ds", "p0", "1,a,x\n")
    run_table(spark, work, exprs)
    os.remove(f"{work}/cp/commits/0")
    if os.path.exists(f"{work}/cp/commits/.0.crc"):
        os.remove(f"{work}/cp/commits/.0.crc")
    run_table(spark, work, exprs)
    assert len([n for n in os.listdir(f"{work}/t/commits") if not n.startswith(".")]) == 1
    assert rows(scan_table(spark, f"{work}/t")) == [(1, "a")]


def test_constraint_failure_stops_the_stream(spark, work):
    KeyedTable.create(spark, f"{work}/t", TABLE)
    drop(f"{work}/ds", "p0", "1,a,x\nbad,b,y\n")
    with pytest.raises(Exception, match="NOT NULL violated"):
        run_table(spark, work, ["timestamp AS id", "my_column"])
    assert rows(scan_table(spark, f"{work}/t")) == []


def test_violating_rows_are_put_aside(spark, work):
    KeyedTable.create(spark, f"{work}/t", [*TABLE, {"column_name": "name", "column_type": "string", "nullable": False}])
    exprs, aside = ["timestamp AS ID", "my_column", "nullif(name, 'y') AS name"], f"{work}/aside"
    drop(f"{work}/ds", "p0", "1,a,x\n2,b,x\n")
    run_table(spark, work, exprs, quarantine=aside)
    assert not os.path.exists(aside) and continuous.quarantined(spark, aside).collect() == []
    drop(f"{work}/ds", "p1", "bad,c,x\n3,d,x\n2,e,y\n")
    run_table(spark, work, exprs, quarantine=aside)
    assert rows(scan_table(spark, f"{work}/t")) == [(1, "a", "x"), (2, "b", "x"), (3, "d", "x")]
    found = continuous.quarantined(spark, aside)
    assert rows(found.select("ID", "my_column", "name", "batch")) == [(2, "e", None, 1), (None, "c", "x", 1)]
    # A replay, after the table's commit and before the rows were put aside or after, gives the same.
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{work}/cp/commits/{name}"):
            os.remove(f"{work}/cp/commits/{name}")
    run_table(spark, work, exprs, quarantine=aside)
    assert continuous.quarantined(spark, aside).count() == 2 and scan_table(spark, f"{work}/t").count() == 3


def test_violating_rows_of_windows_are_put_aside(spark, work):
    KeyedTable.create(spark, f"{work}/t", [TABLE[0], {"column_name": "before", "column_type": "string", "nullable": False}])
    exprs = ["timestamp AS id", "lag(my_column) OVER (PARTITION BY name ORDER BY timestamp) AS before"]
    drop(f"{work}/ds", "p0", "1,a,x\n2,b,x\n5,c,y\n")
    run_table(spark, work, exprs, quarantine=f"{work}/aside")
    assert rows(scan_table(spark, f"{work}/t")) == [(2, "a")]
    assert rows(continuous.quarantined(spark, f"{work}/aside").select("id")) == [(1,), (5,)]
    drop(f"{work}/ds", "p1", "6,d,y\n")
    run_table(spark, work, exprs, quarantine=f"{work}/aside")
    assert rows(scan_table(spark, f"{work}/t")) == [(2, "a"), (6, "c")]
    assert rows(continuous.quarantined(spark, f"{work}/aside").select("id", "batch")) == [(1, 0), (5, 0), (5, 1)]


def test_compaction_on_the_way(spark, work):
    KeyedTable.create(spark, f"{work}/t", TABLE, buckets=2)
    for n in range(5):
        drop(f"{work}/ds", f"p{n}", f"{n},v{n},x\n0,z{n},x\n")
    run_table(spark, work, ["timestamp AS id", "my_column"], source_options={"maxFilesPerTrigger": 1}, compact_every=2)
    assert len(os.listdir(f"{work}/t/versions")) >= 2
    assert scan_table(spark, f"{work}/t").count() == 5


def test_outputs(spark, broker, work):
    drop(f"{work}/ds", "p0", "1,a,x\n2,,y\n")
    flows.dataset_to_topic(spark, f"{work}/ds", SCHEMA, broker, "d", ["timestamp", "name"])
    assert values(spark, broker, "d") == ["1,x", "2,y"]
    flows.dataset_to_topic(spark, f"{work}/ds", SCHEMA, broker, "all")
    assert values(spark, broker, "all") == ["1,a,x", "2,y"]
    flows.dataset_to_topic(spark, f"{work}/ds", SCHEMA, broker, "q", quoted=True)
    assert values(spark, broker, "q") == ["1,a,x", "2,\\N,y"]
    KeyedTable.create(spark, f"{work}/t", TABLE)
    flows.dataset_to_table(spark, f"{work}/ds", SCHEMA, f"{work}/t", ["timestamp AS id", "my_column"])
    flows.table_to_topic(spark, f"{work}/t", broker, "t")
    assert values(spark, broker, "t") == ["1,a", "2"]
    flows.table_to_topic(spark, f"{work}/t", broker, "t1", where="my_column IS NOT NULL")
    assert values(spark, broker, "t1") == ["1,a"]
    flows.table_to_topic(spark, f"{work}/t", broker, "t2", where=["id = 2", F.col("my_column").isNull()])
    assert values(spark, broker, "t2") == ["2"]


def test_continuous_output(spark, broker, work):
    def run(topic, exprs):
        flows.dataset_to_topic(
            spark,
            f"{work}/ds",
            SCHEMA,
            broker,
            topic,
            exprs,
            continuous=True,
            checkpoint=f"{work}/cp-{topic}",
            trigger=ONCE,
        ).awaitTermination()

    drop(f"{work}/ds", "p0", "1,a,x\n2,b,y\n")
    run("rows", ["timestamp"])
    run("total", ["count(*)"])
    run("distinct", ["count(DISTINCT name)"])
    drop(f"{work}/ds", "p1", "3,c,x\n")
    run("rows", ["timestamp"])
    run("total", ["count(*)"])
    run("distinct", ["count(DISTINCT name)"])
    assert values(spark, broker, "rows") == ["1", "2", "3"]
    assert values(spark, broker, "total") == ["2", "3"]
    assert values(spark, broker, "distinct") == ["2", "2"]


def test_batch_and_stream_load_the_same_table(spark, events, work):
    encode_rows(events.repartition(5)).write.text(f"{work}/ds")
    schema = from_struct(events.schema)
    keyed = [{**c, "primary_key": c["column_name"] == "user_id", "nullable": c["column_name"] != "user_id"} for c in schema]
    for kind in ("once", "stream"):
        KeyedTable.create(spark, f"{work}/{kind}", keyed, sequence_by=["event_id"])
    flows.dataset_to_table(spark, f"{work}/ds", schema, f"{work}/once", ["*"])
    flows.dataset_to_table(
        spark,
        f"{work}/ds",
        schema,
        f"{work}/stream",
        ["*"],
        continuous=True,
        checkpoint=f"{work}/cp",
        trigger=ONCE,
        source_options={"maxFilesPerTrigger": 1},
    ).awaitTermination()
    assert rows(scan_table(spark, f"{work}/once")) == rows(scan_table(spark, f"{work}/stream"))


WINDOWED = ["my_column", "timestamp AS id", "count(*) OVER (PARTITION BY my_column) AS n"]


def test_windows_are_evaluated_for_touched_partitions_only(spark, work):
    target = [*TABLE, {"column_name": "n", "column_type": "biginteger"}]
    KeyedTable.create(spark, f"{work}/t", target)
    drop(f"{work}/ds", "p0", "1,a,x\n2,b,x\n3,b,y\n4,,y\n")
    run_table(spark, work, WINDOWED)
    drop(f"{work}/ds", "p1", "5,b,x\n6,,x\n7,c,x\n")
    run_table(spark, work, WINDOWED)
    assert rows(scan_table(spark, f"{work}/t")) == rows(
        spark.createDataFrame([(1, "a", 1), (2, "b", 3), (3, "b", 3), (5, "b", 3), (4, None, 2), (6, None, 2), (7, "c", 1)], "a long, b string, c long")
    )
    logged = sorted(os.listdir(f"{work}/t/log"))
    assert [spark.read.parquet(f"{work}/t/log/{f}").count() for f in logged] == [4, 6]

    how, stream, rows_of = continuous._follow(spark, f"{work}/ds", SCHEMA, WINDOWED, None, None, {})
    assert how == "parts" and stream.columns == [c["column_name"] for c in SCHEMA]
    found = rows_of(spark.createDataFrame([(9, "b", "z"), (9, "b", "z")], "timestamp long, my_column string, other string"))
    assert rows(found) == [("b", 2, 3), ("b", 3, 3), ("b", 5, 3)]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("expr", "keys"),
    [
        ("sum(1) OVER (PARTITION BY a)", ["a"]),
        ("sum(1) OVER (PARTITION BY a, b) + max(c) OVER (PARTITION BY b, upper(a))", ["b"]),
        ("sum(1) OVER (PARTITION BY upper(a))", []),
        ("sum(1) OVER (PARTITION BY a) + sum(1) OVER (PARTITION BY b)", []),
        ("sum(1) OVER (ORDER BY a)", []),
        ("sum(1) OVER (PARTITION BY a) + (SELECT 1)", []),
        ("explode(array(a)) AS x, sum(1) OVER (PARTITION BY a)", []),
        ("a", []),
    ],
)
def test_keys_that_all_windows_share(spark, expr, keys):
    empty = spark.createDataFrame([], "a string, b string, c long")
    assert shape.window_keys(empty.selectExpr(*expr.split(" AS x, ") if "AS x" in expr else [expr])) == keys


def test_changes_of_a_table(spark, work):
    target = KeyedTable.create(spark, f"{work}/t", [*TABLE, {"column_name": "v", "column_type": "integer"}], sequence_by=["v"])
    sent = []

    def run():
        sent.clear()
        send = lambda df, epoch: sent.extend(map(tuple, df.collect()))
        continuous.stream_changes(spark, f"{work}/t", send, checkpoint=f"{work}/feed", trigger=ONCE).awaitTermination()
        return sorted(sent)

    put = lambda *r: target.upsert(spark.createDataFrame(list(r), "id long, my_column string, v int"))
    put((1, "a", 1), (2, "b", 1))
    put((2, "c", 2), (3, None, 1))
    assert run() == [(1, "a", 1), (2, "c", 2), (3, None, 1)]
    put((1, "a", 1), (2, "old", 1), (3, "d", 2))  # the same, out of order, changed
    assert run() == [(3, "d", 2)]
    put((3, "d", 2))
    assert run() == [] and run() == []
    put((4, "e", 1))
    target.compact()  # folds what was not sent yet
    put((1, "f", 5))
    assert run() == [(1, "f", 5), (4, "e", 1)]
