import pytest

from millrace.operators.related import AmbiguousNameError, NotFoundError, to_records
from millrace.functions.schema import SchemaError
from millrace.plans.catalog import Catalog
from millrace.sources import topics
from millrace.sources.keyed_table import scan_table
from tests.conftest import rows
from tests.directory_broker import DirectoryBroker
from tests.test_flows import ONCE, SCHEMA, TABLE, values

EXPRS = ["timestamp AS id", "my_column"]


@pytest.fixture
def catalog(spark, work):
    return Catalog(spark, work, DirectoryBroker(f"{work}/topics"))


def landed(spark, catalog, *lines):
    dataset = catalog.register_dataset("sensor", SCHEMA, land=False).id
    topics.write_topic(spark.createDataFrame([(line,) for line in lines], "value string"), catalog.broker, dataset)
    catalog.start_landing(dataset, start={"earliest": True}, trigger=ONCE).query.awaitTermination()
    return dataset


def test_two_topics_land_in_one_dataset(spark, catalog):
    dataset = landed(spark, catalog, "1,a,x")
    topics.write_topic(spark.createDataFrame([("2,b,y",)], "value string"), catalog.broker, "more")
    catalog.start_landing(dataset, topic="more", start={"earliest": True}, trigger=ONCE).query.awaitTermination()
    loaded = catalog.register_table(dataset, "latest", TABLE, EXPRS, trigger=ONCE)
    loaded.query.awaitTermination()
    assert rows(scan_table(spark, catalog.table_path(loaded.id))) == [(1, "a"), (2, "b")]


def test_whole_course(spark, catalog):
    dataset = landed(spark, catalog, "1,a,x", "2,b,y", "1,c,z")
    assert [r["name"] for r in to_records(catalog.datasets(), ["name"])] == ["sensor"]
    assert catalog.schema_of(dataset)[0]["column_type"] == "biginteger"

    loaded = catalog.register_table(dataset, "latest", TABLE, EXPRS, trigger=ONCE)
    loaded.query.awaitTermination()
    assert loaded.id.startswith("table_") and "-" not in loaded.id
    assert rows(scan_table(spark, catalog.table_path(loaded.id)).select("id")) == [(1,), (2,)]
    assert catalog.table_id(dataset, "latest") == loaded.id
    assert rows(catalog.dataset_table(dataset, loaded.id).select("name")) == [("latest",)]

    out = catalog.register_dataset_output(dataset, ["timestamp", "name"])
    assert values(spark, catalog.broker, out.topic) == ["1,x", "1,z", "2,y"]
    again = catalog.register_dataset_output(dataset, ["name"], continuous=True, where="timestamp = 2", trigger=ONCE)
    again.query.awaitTermination()
    assert values(spark, catalog.broker, again.topic) == ["y"]
    of_table = catalog.register_table_output(dataset, "latest")
    assert len(values(spark, catalog.broker, of_table.topic)) == 2

    assert rows(catalog.dataset_outputs(dataset).select("id")) == sorted([(out.flow_id,), (again.flow_id,)])
    assert rows(catalog.dataset_outputs(dataset, out.flow_id).select("id")) == [(out.flow_id,)]
    # The flow that loads the table refers to it too, and is no output of it.
    assert rows(catalog.table_outputs(dataset, "latest").select("id")) == [(of_table.flow_id,)]
    assert catalog.table_outputs(dataset, loaded.id, out.flow_id).isEmpty()

    details = catalog.dataset_details(dataset)
    assert {name: df.count() for name, df in details.items()} == {
        "datasets": 1,
        "stream_flows": 1,
        "batch_flows": 4,
        "data_tables": 1,
    }


def test_soft_delete(spark, catalog):
    dataset = catalog.register_dataset("gone", SCHEMA, land=False).id
    kept = catalog.register_dataset("kept", SCHEMA, land=False).id
    catalog.soft_delete("datasets", dataset)
    assert rows(catalog.datasets().select("id")) == [(kept,)]
    assert catalog.dataset(dataset).isEmpty() and catalog.dataset_details(dataset) == {}
    whole = {r["id"]: r for r in to_records(catalog.dump("datasets"))}
    assert whole[dataset]["name"] == "gone" and whole[dataset]["tombstone"] is not None
    assert whole[kept]["tombstone"] is None
    with pytest.raises(NotFoundError):
        catalog.soft_delete("datasets", dataset)
    with pytest.raises(NotFoundError):
        catalog.register_table(dataset, "t", TABLE, EXPRS)
    with pytest.raises(NotFoundError):
        catalog.register_dataset_output(dataset)


def test_names_within_a_dataset(spark, catalog):
    dataset = landed(spark, catalog, "1,a,x")
    first = catalog.register_table(dataset, "twin", TABLE, EXPRS, continuous=False)
    second = catalog.register_table(dataset, "twin", TABLE, EXPRS, continuous=False)
    with pytest.raises(AmbiguousNameError):
        catalog.table_id(dataset, "twin")
    assert catalog.table_id(dataset, second.id) == second.id
    catalog.soft_delete("data_tables", first.id)
    assert catalog.table_id(dataset, "twin") == second.id
    with pytest.raises(NotFoundError):
        catalog.register_table_output(dataset, "nothing")


def test_changes_are_folded_on_request(spark, catalog):
    ids = [catalog.register_dataset(f"d{n}", SCHEMA, land=False).id for n in range(4)]
    catalog.soft_delete("datasets", ids[0])
    assert catalog._table("datasets").pending() == 5
    catalog.compact()
    assert catalog._table("datasets").pending() == 0
    assert rows(catalog.datasets().select("name")) == [("d1",), ("d2",), ("d3",)]
    assert catalog.dump("datasets").count() == 4


def test_bad_schemas_leave_no_row(catalog):
    with pytest.raises(SchemaError):
        catalog.register_dataset("bad", [{"column_name": "a", "column_type": "decimal"}])
    assert catalog.datasets().isEmpty()
    dataset = catalog.register_dataset("good", SCHEMA, land=False).id
    with pytest.raises(SchemaError):
        catalog.register_table(dataset, "no-key", SCHEMA[1:], ["*"])
    with pytest.raises(ValueError):
        catalog.register_table(dataset, "no-exprs", TABLE, [])
    assert catalog.dataset_tables(dataset).isEmpty()


def test_dataset_with_a_bucket_column_lands(spark, catalog):
    schema = [*SCHEMA[:2], {"column_name": "bucket", "column_type": "string"}]
    dataset = catalog.register_dataset("b", schema, land=False).id
    topics.write_topic(spark.createDataFrame([("1,a,mine",)], "value string"), catalog.broker, dataset)
    catalog.start_landing(dataset, start={"earliest": True}, trigger=ONCE).query.awaitTermination()
    out = catalog.register_dataset_output(dataset)
    assert values(spark, catalog.broker, out.topic) == ["1,a,mine"]


def test_table_registered_before_anything_landed(spark, catalog):
    dataset = catalog.register_dataset("early", SCHEMA, land=False).id
    loaded = catalog.register_table(dataset, "t", TABLE, EXPRS, trigger=ONCE)
    loaded.query.awaitTermination()
    assert scan_table(spark, catalog.table_path(loaded.id)).isEmpty()


def test_landing_starts_with_the_registration(spark, catalog):
    registered = catalog.register_dataset("now", SCHEMA, start={"earliest": True}, trigger={"processingTime": "1 second"})
    try:
        # Nothing has landed yet.
        empty = catalog.register_dataset_output(registered.id)
        assert values(spark, catalog.broker, empty.topic) == []
        topics.write_topic(spark.createDataFrame([("1,a,x",)], "value string"), catalog.broker, registered.topic)
        registered.query.processAllAvailable()
    finally:
        registered.query.stop()
    out = catalog.register_dataset_output(registered.id, ["my_column"])
    assert values(spark, catalog.broker, out.topic) == ["a"]
    flow = catalog.dataset_details(registered.id)["stream_flows"].first()
    assert (flow.id, flow.run_id) == (registered.flow_id, str(registered.query.id))
