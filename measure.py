"""

Uses the same environment variables as ``bench.py``.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.rows import encode_rows
from millrace.functions.schema import from_struct
from millrace.plans import flows
from millrace.queries import events_schema, land, table, workspace
from millrace.sources.datasets import scan_dataset
from millrace.sources.topics import Broker, write_topic
from millrace.sources.keyed_table import KeyedTable, scan_table

CYCLES = 10


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], Any], warm: bool = True) -> float:
    if warm:
        action()
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    root = workspace(spark)
    found: dict[str, Any] = {}

    lines = table(spark, sf_dir, "lineitem")
    schema = land(lines, f"{root}/lineitem")
    seconds = timed(lambda: noop(encode_rows(scan_dataset(spark, f"{root}/lineitem", schema))))
    found["scan_encode_rows_per_s"] = round(lines.count() / seconds)

    orders = table(spark, sf_dir, "orders")
    keyed = from_struct(orders.schema, ["o_orderkey"])
    schema = land(orders, f"{root}/orders")

    def load_orders() -> None:
        KeyedTable.create(spark, f"{root}/orders-table", keyed, if_not_exists=True)
        flows.dataset_to_table(spark, f"{root}/orders", schema, f"{root}/orders-table", ["*"])

    found["dataset_to_table_s"] = timed(load_orders)

    events = table(spark, sf_dir, "events")
    arrivals = events.randomSplit([1.0] * CYCLES, seed=1)
    schema = from_struct(events.schema)
    for name in ("incremental", "reload"):
        KeyedTable.create(spark, f"{root}/{name}", events_schema("user_id"), sequence_by=["event_id"])
    cycles: dict[str, list[float]] = {"incremental": [], "reload": []}
    rows_read: dict[str, list[int]] = {"incremental": [], "reload": []}
    for number, arrival in enumerate(arrivals):
        encode_rows(arrival).write.text(f"{root}/landed/{number}")

        def incremental() -> None:
            query = flows.dataset_to_table(
                spark,
                f"{root}/landed",
                schema,
                f"{root}/incremental",
                ["*"],
                continuous=True,
                checkpoint=f"{root}/checkpoint",
                trigger={"availableNow": True},
            )
            query.awaitTermination()
            rows_read["incremental"].append(sum(p["numInputRows"] for p in query.recentProgress))
            cycles["incremental"].append(sum(p["durationMs"]["addBatch"] for p in query.recentProgress) / 1000)

        incremental()
        cycles["reload"].append(
            timed(
                lambda: flows.dataset_to_table(spark, f"{root}/landed", schema, f"{root}/reload", ["*"]), warm=False
            )
        )
        rows_read["reload"].append(scan_dataset(spark, f"{root}/landed", schema).count())
    # The first cycles warm the JVM up.
    half = CYCLES // 2
    found["continuous_load_s_per_cycle"] = {k: round(sum(v[half:]) / len(v[half:]), 3) for k, v in cycles.items()}
    found["continuous_load_rows_read"] = {k: sum(v) for k, v in rows_read.items()}

    found["table_read_s_before_compaction"] = timed(lambda: noop(scan_table(spark, f"{root}/incremental")))
    compaction = time.perf_counter()
    KeyedTable.open(spark, f"{root}/incremental").compact()
    found["compaction_s"] = round(time.perf_counter() - compaction, 3)
    found["table_read_s_after_compaction"] = timed(lambda: noop(scan_table(spark, f"{root}/incremental")))

    broker = Broker({"path": f"{root}/topics/{{topic}}"}, "parquet", "key STRING, value STRING")
    write_topic(encode_rows(events), broker, "events")
    copies = iter(range(10))

    def copy() -> None:
        number = next(copies)
        flows.topic_to_topic(
            spark,
            broker,
            "events",
            f"copy-{number}",
            checkpoint=f"{root}/copy-checkpoint-{number}",
            start={"earliest": True},
            trigger={"availableNow": True},
        ).awaitTermination()

    found["topic_copy_rows_per_s"] = round(events.count() / timed(copy))
    print(json.dumps({"sf": sf_dir, "cpus": cpus, **found}))
    spark.stop()


if __name__ == "__main__":
    main()
