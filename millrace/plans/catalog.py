"""The catalog of datasets, tables and flows, and their registration.

The catalog is three keyed tables.  Rows are never removed: a deletion sets
their tombstone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import ids
from millrace.functions.schema import Column as SchemaColumn
from millrace.functions.schema import check_schema, from_json, to_json
from millrace.operators import related
from millrace.operators.project import matches, select_columns
from millrace.plans import flows
from millrace.sources import storage
from millrace.sources.keyed_table import ConcurrentWriteError, KeyedTable
from millrace.sources.topics import Broker
from millrace.streaming.landing import bucket_column


def _columns(**kinds: str) -> list[SchemaColumn]:
    return check_schema(
        {"column_name": name, "column_type": kind, "nullable": name != "id", "primary_key": name == "id"}
        for name, kind in kinds.items()
    )


# The catalog tables and their columns.
CATALOG_TABLES: dict[str, list[SchemaColumn]] = {
    "datasets": _columns(id="string", name="string", timestamp="timestamp", tombstone="timestamp"),
    "data_tables": _columns(
        id="string", dataset_id="string", name="string", timestamp="timestamp", tombstone="timestamp"
    ),
    "dataflows": _columns(
        id="string",
        flow_kind="string",
        run_id="string",
        dataset_id="string",
        data_table_id="string",
        timestamp="timestamp",
        tombstone="timestamp",
    ),
}

# What a flow does: fill a dataset from its topic, load a table, or fill an output topic.
LANDING, LOAD, OUTPUT = "landing", "load", "output"

# Tries for a change that meets another process changing the catalog.
WRITE_ATTEMPTS = 5


def _now() -> datetime:
    """The present, with its zone: right in any session time zone."""
    return datetime.now(timezone.utc)


class Registered(NamedTuple):
    """What was registered; ``query`` is set while a continuous flow runs."""

    id: str
    flow_id: str | None = None
    topic: str | None = None
    query: StreamingQuery | None = None


class Catalog:
    """Catalog tables, schemas, datasets and tables below one root directory."""

    def __init__(self, spark: SparkSession, root: str, broker: Broker):
        self.spark = spark
        self.root = root.rstrip("/")
        self.broker = broker
        for name, schema in CATALOG_TABLES.items():
            # A handful of rows each: one bucket is enough.
            KeyedTable.create(
                spark, self._catalog_path(name), schema, partial_updates=True, buckets=1, if_not_exists=True
            )

    # ---- places

    def _catalog_path(self, name: str) -> str:
        return f"{self.root}/catalog/{name}"

    def dataset_path(self, dataset_id: str) -> str:
        return f"{self.root}/datasets/{dataset_id}"

    def table_path(self, table_id: str) -> str:
        return f"{self.root}/tables/{table_id}"

    def schema_of(self, id: str) -> list[SchemaColumn]:
        """The stored schema of a dataset or table."""
        return from_json(storage.read_text(self.spark, f"{self.root}/schemas/{id}"))

    def _checkpoint(self, flow_id: str) -> str:
        return f"{self.root}/checkpoints/{flow_id}"

    # ---- reading

    def _table(self, name: str) -> KeyedTable:
        return KeyedTable.open(self.spark, self._catalog_path(name))

    def dump(self, name: str) -> DataFrame:
        """Every row of a catalog table, deleted ones included."""
        return self._table(name).read()

    def datasets(self) -> DataFrame:
        return select_columns(related.live_rows(self.dump("datasets")), "id", "name", "timestamp")

    def dataset(self, dataset_id: str) -> DataFrame:
        """The live dataset with this id, or no row."""
        found = related.live_rows(self._table("datasets").lookup(id=dataset_id))
        return select_columns(found, "id", "name", "timestamp")

    def dataset_details(self, dataset_id: str) -> dict[str, DataFrame]:
        """A dataset with its flows and its live tables; nothing if it is not live."""
        own = self.dataset(dataset_id)
        if own.isEmpty():
            return {}
        mine = matches(equal={"dataset_id": dataset_id})
        flow_rows = related.live_rows(self.dump("dataflows").where(mine))
        landing = F.col("flow_kind") == LANDING
        return {
            "datasets": own,
            "stream_flows": select_columns(flow_rows.where(landing), "id", "run_id", "dataset_id", "timestamp"),
            "batch_flows": select_columns(
                flow_rows.where(~landing), "id", "flow_kind", "dataset_id", "data_table_id", "timestamp"
            ),
            "data_tables": self.dataset_tables(dataset_id),
        }

    def dataset_tables(self, dataset_id: str) -> DataFrame:
        children = related.list_children(self.dump("data_tables"), dataset_id, parent_column="dataset_id")
        return select_columns(children, "id", "dataset_id", "name", "timestamp")

    def dataset_table(self, dataset_id: str, id_or_name: str) -> DataFrame:
        """Live tables of a dataset with this id or name."""
        found = related.find_by_id_or_name(
            self.dump("data_tables"), id_or_name, parent=dataset_id, parent_column="dataset_id"
        )
        return select_columns(found, "id", "dataset_id", "name", "timestamp")

    def table_id(self, dataset_id: str, id_or_name: str) -> str:
        """The id of one live table; raises when there is none or no single one."""
        return related.resolve_id(
            self.dump("data_tables"), id_or_name, parent=dataset_id, parent_column="dataset_id"
        )

    def dataset_outputs(self, dataset_id: str, output_id: str | None = None) -> DataFrame:
        """Live outputs taken from the dataset itself, or one of them."""
        return self._outputs(dataset_id, output_id, F.col("data_table_id").isNull())

    def table_outputs(self, dataset_id: str, id_or_name: str, output_id: str | None = None) -> DataFrame:
        """Live outputs taken from a table, or one of them; the flow that loads it is none."""
        table_id = self.table_id(dataset_id, id_or_name)
        return self._outputs(dataset_id, output_id, F.col("data_table_id") == table_id)

    def _outputs(self, dataset_id: str, output_id: str | None, source: Column) -> DataFrame:
        equal = {"dataset_id": dataset_id, "flow_kind": OUTPUT}
        if output_id is not None:
            equal["id"] = output_id
        found = related.live_rows(self.dump("dataflows").where(matches(equal=equal) & source))
        return select_columns(found, "id", "dataset_id", "data_table_id", "timestamp")

    # ---- registering

    def register_dataset(
        self,
        name: str,
        schema: Sequence[Mapping[str, Any]],
        *,
        start: Mapping[str, Any] | None = None,
        land: bool = True,
        **landing: Any,
    ) -> Registered:
        """Record a dataset and start landing the topic named by its id."""
        checked = check_schema(schema)
        dataset_id = ids.new_id("dataset")
        self._put("datasets", id=dataset_id, name=name, timestamp=_now(), tombstone=None)
        self._put_schema(dataset_id, checked)
        storage.make_dir(self.spark, self.dataset_path(dataset_id))
        if not land:
            return Registered(dataset_id)
        return self._land(dataset_id, checked, start, landing)

    def start_landing(
        self, dataset_id: str, *, topic: str | None = None, start: Mapping[str, Any] | None = None, **landing: Any
    ) -> Registered:
        """Start landing a dataset that was registered with ``land=False``; or one more ``topic`` of such lines in it."""
        self._need_dataset(dataset_id)
        return self._land(dataset_id, self.schema_of(dataset_id), start, landing, topic)

    def _land(
        self,
        dataset_id: str,
        schema: list[SchemaColumn],
        start: Mapping[str, Any] | None,
        landing: dict[str, Any],
        topic: str | None = None,
    ) -> Registered:
        flow_id = ids.new_id("stream")
        if topic is not None:
            landing.setdefault("source", topic)
        landing.setdefault("bucket", bucket_column([c["column_name"] for c in schema]))
        query = flows.topic_to_dataset(
            self.spark,
            self.broker,
            topic or dataset_id,
            self.dataset_path(dataset_id),
            checkpoint=self._checkpoint(f"landing-{dataset_id}" if topic is None else f"landing-{dataset_id}-{topic}"),
            start=start or {"group_id": dataset_id},
            **landing,
        )
        self._put_flow(flow_id, LANDING, dataset_id, query=query)
        return Registered(dataset_id, flow_id, dataset_id, query)

    def register_table(
        self,
        dataset_id: str,
        name: str,
        schema: Sequence[Mapping[str, Any]],
        exprs: Sequence[str],
        *,
        continuous: bool = True,
        where: str | Column | None = None,
        sequence_by: Sequence[str] = (),
        buckets: int | None = None,
        **options: Any,
    ) -> Registered:
        """Create a table under a live dataset and load it, continuously by default."""
        checked = check_schema(schema, need_key=True)
        flows.need_expressions(exprs)
        self._need_dataset(dataset_id)
        table_id = ids.new_table_id()
        self._put(
            "data_tables",
            absent_only=True,
            id=table_id,
            dataset_id=dataset_id,
            name=name,
            timestamp=_now(),
            tombstone=None,
        )
        KeyedTable.create(
            self.spark, self.table_path(table_id), checked, sequence_by=sequence_by, buckets=buckets, if_not_exists=True
        )
        self._put_schema(table_id, checked)
        flow_id = ids.new_id("flow")
        if continuous:
            options["checkpoint"] = self._checkpoint(flow_id)
        outcome = flows.dataset_to_table(
            self.spark,
            self.dataset_path(dataset_id),
            self.schema_of(dataset_id),
            self.table_path(table_id),
            exprs,
            where=where,
            continuous=continuous,
            **options,
        )
        query = outcome if continuous else None
        self._put_flow(flow_id, LOAD, dataset_id, table_id=table_id, query=query)
        return Registered(table_id, flow_id, None, query)

    def register_dataset_output(
        self,
        dataset_id: str,
        exprs: Sequence[str] = (),
        *,
        continuous: bool = False,
        where: str | Column | None = None,
        **options: Any,
    ) -> Registered:
        """Fill a new topic, named by the flow id, from a live dataset."""
        self._need_dataset(dataset_id)
        flow_id = ids.new_id("flow")
        if continuous:
            options["checkpoint"] = self._checkpoint(flow_id)
        query = flows.dataset_to_topic(
            self.spark,
            self.dataset_path(dataset_id),
            self.schema_of(dataset_id),
            self.broker,
            flow_id,
            exprs,
            where=where,
            continuous=continuous,
            **options,
        )
        self._put_flow(flow_id, OUTPUT, dataset_id, query=query)
        return Registered(dataset_id, flow_id, flow_id, query)

    def register_table_output(
        self,
        dataset_id: str,
        id_or_name: str,
        *,
        where: str | Column | None = None,
        continuous: bool = False,
        **options: Any,
    ) -> Registered:
        """Fill a new topic, named by the flow id, from a table of a live dataset; continuously, with what changes there."""
        self._need_dataset(dataset_id)
        table_id = self.table_id(dataset_id, id_or_name)
        flow_id = ids.new_id("flow")
        if continuous:
            options["checkpoint"] = self._checkpoint(flow_id)
        path = self.table_path(table_id)
        query = flows.table_to_topic(self.spark, path, self.broker, flow_id, where=where, continuous=continuous, **options)
        self._put_flow(flow_id, OUTPUT, dataset_id, table_id=table_id, query=query)
        return Registered(table_id, flow_id, flow_id, query)

    def soft_delete(self, name: str, id: str) -> None:
        """Mark one row of a catalog table as deleted; its other columns stay."""
        found = related.live_rows(self._table(name).lookup(id=id))
        if found.isEmpty():
            raise related.NotFoundError(f"no live row {id} in {name}")
        self._put(name, id=id, tombstone=_now())

    # ---- writing

    def _need_dataset(self, dataset_id: str) -> None:
        if self.dataset(dataset_id).isEmpty():
            raise related.NotFoundError(f"dataset {dataset_id} not found")

    def _put(self, into: str, /, *, absent_only: bool = False, **values: Any) -> None:
        # The range keeps the one row free of Python tasks.
        row = self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()])
        table = self._table(into)
        write = table.insert_if_absent if absent_only else table.upsert
        for attempt in range(WRITE_ATTEMPTS):
            try:
                write(row.coalesce(1))
                break
            except ConcurrentWriteError:
                if attempt + 1 == WRITE_ATTEMPTS:
                    raise

    def compact(self) -> None:
        """Fold the changes to the catalog, a batch of one row each; nothing is deleted."""
        for name in CATALOG_TABLES:
            self._table(name).compact()

    def _put_flow(
        self,
        flow_id: str,
        kind: str,
        dataset_id: str,
        *,
        table_id: str | None = None,
        query: StreamingQuery | None = None,
    ) -> None:
        try:
            self._put(
                "dataflows",
                id=flow_id,
                flow_kind=kind,
                run_id=str(query.id) if query else None,
                dataset_id=dataset_id,
                data_table_id=table_id,
                timestamp=_now(),
                tombstone=None,
            )
        except Exception:
            # A flow that the catalog doesn't know must not run on.
            if query:
                query.stop()
            raise

    def _put_schema(self, id: str, schema: Sequence[Mapping[str, Any]]) -> None:
        storage.put_text(self.spark, f"{self.root}/schemas/{id}", to_json(schema))
