import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.rows import encode_rows
from millrace.functions.schema import from_struct
from millrace.sources.datasets import scan_dataset, scan_dataset_stream
from tests.conftest import rows

SCHEMA = [
    {"column_name": "timestamp", "column_type": "biginteger", "nullable": False, "primary_key": True},
    {"column_name": "my_column", "column_type": "string"},
    {"column_name": "name", "column_type": "string"},
]
EDGE = '1,a,x\n2,,y\nbad,b,z\n4,c\n5,d,e,extra\n6,"q,r",s\n'
READ = [(1, "a", "x"), (2, None, "y"), (4, "c", None), (5, "d", "e"), (6, "q,r", "s"), (None, "b", "z")]


@pytest.fixture
def edge(work):
    os.makedirs(f"{work}/deep/er")
    os.makedirs(f"{work}/empty")
    with open(f"{work}/part-0", "w") as f:
        f.write(EDGE)
    with open(f"{work}/.part-0-2.inprogress.abc", "w") as f:
        f.write("9,hidden,x\n")
    with open(f"{work}/deep/er/part-1", "w") as f:
        f.write("7,n,t\n")
    return work


def test_edge_lines(spark, edge):
    assert rows(scan_dataset(spark, edge, SCHEMA)) == sorted([*READ, (7, "n", "t")], key=lambda r: (r[0] is None, str(r[0])))


def test_modes(spark, edge):
    kept = scan_dataset(spark, edge, SCHEMA, mode="DROPMALFORMED")
    assert {1, 2, 6, 7} <= {r.timestamp for r in kept.collect()}
    assert None not in {r.timestamp for r in kept.collect()}
    with pytest.raises(Exception, match="MALFORMED"):
        scan_dataset(spark, edge, SCHEMA, mode="FAILFAST").collect()


def test_corrupt_record(spark, edge):
    flagged = scan_dataset(spark, edge, SCHEMA, corrupt=True)
    bad = [r._corrupt_record for r in flagged.collect() if r._corrupt_record]
    assert sorted(bad) == ["4,c", "5,d,e,extra", "bad,b,z"]


def test_stream_equals_batch(spark, edge, work):
    out = f"{work}-out"
    stream = scan_dataset_stream(spark, edge, SCHEMA, options={"maxFilesPerTrigger": 1})
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{work}-cp")
    query.trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(scan_dataset(spark, edge, SCHEMA))


def test_event_text_round_trip_keeps_microseconds(spark, events, work):
    encode_rows(events).write.text(work)
    back = scan_dataset(spark, work, from_struct(events.schema))
    same = events.withColumn("ts", F.col("ts").cast("timestamp"))
    assert same.exceptAll(back).isEmpty() and back.count() == events.count()


def test_bucket_filter_prunes_directories(spark, work):
    for hour in ("2024-01-01--00", "2024-01-01--01"):
        os.makedirs(f"{work}/bucket={hour}")
        with open(f"{work}/bucket={hour}/part", "w") as f:
            f.write(f"1,a,{hour}\n")
    scan = scan_dataset(spark, work, SCHEMA, bucket="bucket").where("bucket > '2024-01-01--00'")
    assert scan.columns == ["timestamp", "my_column", "name", "bucket"]
    assert rows(scan) == [(1, "a", "2024-01-01--01", "2024-01-01--01")]
    assert "PartitionFilters: [isnotnull(bucket" in scan._jdf.queryExecution().toString()
    assert scan_dataset(spark, work, SCHEMA).columns == ["timestamp", "my_column", "name"]


def test_all_six_types(spark, work):
    os.makedirs(work)
    with open(f"{work}/part", "w") as f:
        f.write("t,1,3000000000,true,1.5,2024-02-03 04:05:06.789012\nt,3000000000,x,yes,one,yesterday\n")
    kinds = ["string", "integer", "biginteger", "boolean", "double", "timestamp"]
    schema = [{"column_name": k, "column_type": k} for k in kinds]
    good, bad = sorted(scan_dataset(spark, work, schema).collect(), key=lambda r: r.integer is None)
    assert good == ("t", 1, 3000000000, True, 1.5, datetime(2024, 2, 3, 4, 5, 6, 789012))
    assert bad == ("t", None, None, None, None, None)


def test_empty_directory(spark, work):
    os.makedirs(work)
    assert scan_dataset(spark, work, SCHEMA).isEmpty()


def test_zone_free_times_stay_as_written(spark, work):
    os.makedirs(work)
    with open(f"{work}/part", "w") as f:
        f.write("1,2024-03-10 02:30:00.5\n2,later\n")
    schema = [{"column_name": "id", "column_type": "integer"}, {"column_name": "at", "column_type": "timestamp"}]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        scan = scan_dataset(spark, work, schema, zone_free=True)
        assert scan.schema["at"].dataType.typeName() == "timestamp_ntz"
        assert rows(scan) == [(1, datetime(2024, 3, 10, 2, 30, 0, 500000)), (2, None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
