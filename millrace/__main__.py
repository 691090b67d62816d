"""One dataflow as a job: ``spark-submit millrace/__main__.py dataset-to-table --path … --table …``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from millrace.functions.schema import Column, from_json
from millrace.plans import flows
from millrace.sources import storage
from millrace.sources.keyed_table import DATABASE, KeyedTable
from millrace.sources.topics import Broker


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description="Run one dataflow.")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *needed: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name, help=about)
        for option in needed:
            command.add_argument(f"--{option}", required=True)
        return command

    def follow(command: argparse.ArgumentParser) -> None:
        command.add_argument("--continuous", action="store_true")
        command.add_argument("--checkpoint")
        command.add_argument("--mode", choices=["PERMISSIVE", "DROPMALFORMED", "FAILFAST"], help="what becomes of lines that don't parse")
        command.add_argument("--scan-quoted", action="store_true", help="the dataset is quoted text")
        command.add_argument("--zone-free", action="store_true", help="read times as they are written")
        options(command)
        trigger(command)

    def options(command: argparse.ArgumentParser) -> None:
        command.add_argument(
            "--source-option", action="append", default=[], type=pair, metavar="NAME=VALUE",
            help="an option of a stream's source, such as maxBytesPerTrigger or maxOffsetsPerTrigger",
        )

    def pair(text: str) -> tuple[str, str]:
        name, sign, value = text.partition("=")
        if not name or not sign:
            raise argparse.ArgumentTypeError(f"not NAME=VALUE: {text}")
        return name, value

    def trigger(command: argparse.ArgumentParser) -> None:
        command.add_argument("--interval", help="time between micro-batches, for example '15 seconds'")
        command.add_argument("--once", action="store_true", help="take what is there, then stop")

    def select(command: argparse.ArgumentParser) -> None:
        command.add_argument("--select-expr", action="append", default=[])
        command.add_argument("--where")

    def source(command: argparse.ArgumentParser) -> None:
        command.add_argument("--group-id")
        command.add_argument("--start-from-earliest", action="store_true")
        command.add_argument("--start-from-latest", action="store_true")
        options(command)
        trigger(command)

    command = job("topic-to-dataset", "land a topic", "bootstrap-servers", "topic", "path", "checkpoint")
    command.add_argument("--max-records-per-file", type=int)
    command.add_argument("--source", help="name of this source, where several land in one dataset")
    source(command)
    source(job("topic-to-topic", "copy a topic", "bootstrap-servers", "topic", "target", "checkpoint"))
    command = job("create-table", "create a keyed table", "table", "schema-path")
    command.add_argument("--sequence-by", action="append", default=[])
    command.add_argument("--buckets", type=int)
    command.add_argument("--partial-updates", action="store_true")
    command.add_argument("--database", default=DATABASE, help="catalog database for the table's base")
    command = job("dataset-to-table", "load a table", "path", "schema-path", "table")
    command.add_argument("--compact-every", type=int, help="micro-batches between two compactions; 0: none")
    command.add_argument("--keep-seconds", type=float, help="age at which replaced files are deleted")
    command.add_argument("--quarantine", help="folder for rows of a continuous load that lack a required column")
    select(command)
    follow(command)
    command = job("dataset-to-topic", "send a dataset", "path", "schema-path", "bootstrap-servers", "topic")
    select(command)
    follow(command)
    command.add_argument("--quoted", action="store_true")
    command = job("table-to-topic", "send a table", "table", "bootstrap-servers", "topic")
    command.add_argument("--where")
    command.add_argument("--quoted", action="store_true")
    command = job("compact-table", "fold a table's change log", "table")
    command.add_argument("--buckets", type=int, help="buckets of the base from here on")
    command.add_argument("--vacuum", action="store_true", help="delete what was replaced")
    command.add_argument("--older-than", type=float, default=0, help="only what was replaced so many seconds ago")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None, broker: Broker | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"millrace {args.job}").getOrCreate()
    if "bootstrap_servers" in args and broker is None:
        broker = Broker({"kafka.bootstrap.servers": args.bootstrap_servers})

    def schema() -> list[Column]:
        return from_json(storage.read_text(spark, args.schema_path))

    def timing() -> dict | None:
        if args.once:
            return {"availableNow": True}
        return {"processingTime": args.interval} if args.interval else None

    query = None
    if args.job in ("topic-to-dataset", "topic-to-topic"):
        start = {"earliest": args.start_from_earliest, "latest": args.start_from_latest, "group_id": args.group_id}
        start["options"] = dict(args.source_option)
        common = {"checkpoint": args.checkpoint, "start": start, "trigger": timing()}
        if args.job == "topic-to-dataset":
            query = flows.topic_to_dataset(
                spark,
                broker,
                args.topic,
                args.path,
                max_records_per_file=args.max_records_per_file,
                source=args.source,
                **common,
            )
        else:
            query = flows.topic_to_topic(spark, broker, args.topic, args.target, **common)
    elif args.job == "create-table":
        KeyedTable.create(
            spark,
            args.table,
            schema(),
            sequence_by=args.sequence_by,
            buckets=args.buckets,
            partial_updates=args.partial_updates,
            database=args.database,
        )
    elif args.job in ("dataset-to-table", "dataset-to-topic"):
        scan = {"quoted": args.scan_quoted, "zone_free": args.zone_free} | ({"mode": args.mode} if args.mode else {})
        common = {"where": args.where, "continuous": args.continuous, "scan_options": scan}
        if args.continuous:
            common |= {"checkpoint": args.checkpoint, "trigger": timing(), "source_options": dict(args.source_option)}
        if args.job == "dataset-to-table":
            if args.continuous and args.compact_every is not None:
                common["compact_every"] = args.compact_every
            if args.continuous and args.keep_seconds is not None:
                common["keep_seconds"] = args.keep_seconds
            if args.continuous and args.quarantine:
                common["quarantine"] = args.quarantine
            query = flows.dataset_to_table(spark, args.path, schema(), args.table, args.select_expr, **common)
        else:
            query = flows.dataset_to_topic(
                spark, args.path, schema(), broker, args.topic, args.select_expr, quoted=args.quoted, **common
            )
    elif args.job == "table-to-topic":
        flows.table_to_topic(spark, args.table, broker, args.topic, where=args.where, quoted=args.quoted)
    else:
        table = KeyedTable.open(spark, args.table)
        table.compact(args.buckets)
        if args.vacuum:
            table.vacuum(older_than=args.older_than)
    if hasattr(query, "awaitTermination"):
        query.awaitTermination()


if __name__ == "__main__":
    main()
