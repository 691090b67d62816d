"""Every registered query against its SQL, run by DuckDB on the same files."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from millrace import queries as registered
from tests.conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(registered.SQL)
    assert set(registered.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = registered.QUERIES[name](spark, SF_DIR)
    expected = duck.execute(registered.SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    expected_rows = comparable(expected.fetchall())
    assert comparable(tuple(r) for r in result.select(*[f"`{c}`" for c in columns]).collect()) == expected_rows
    assert expected_rows, "the query should return something at this scale"
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unscalable in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert unscalable not in plan


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
