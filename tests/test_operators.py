import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import related
from millrace.operators.constraints import check_constraints, null_violations
from millrace.operators.project import NoSuchColumnError, matches, project, select_columns
from millrace.plans.shape import growth, is_row_local, window_keys
from tests.conftest import rows

ROW_LOCAL = [
    "upper(event_type)",
    "explode(split(props, ':'))",
    "CASE WHEN value > 1 THEN 'a' END AS c",
    "'Window' AS w",
    "'Aggregate [x]' AS a",
    "transform(array(1, 2), x -> x + user_id) AS t",
    "get_json_object(props, '$.k') AS k",
]
STATE = ["count(*)", "max(value) + 1", "percentile_approx(value, 0.5) AS p", "max_by(event_type, event_id) AS e"]
WHOLE_INPUT = [
    "monotonically_increasing_id() AS i",
    "count(DISTINCT user_id)",
    "explode(collect_set(event_type)) AS e",
    "max(value) / (SELECT max(id) FROM range(5)) AS r",
    "sum(value) OVER () AS s",
    "(SELECT max(id) FROM range(5)) AS m",
    "user_id IN (SELECT id FROM range(5)) AS i",
    "concat('a', (SELECT count(*) FROM range(3))) AS nested",
]
PARTITIONED = [
    "count(*) OVER (PARTITION BY user_id) AS n",
    "row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn",
]


@pytest.mark.parametrize("expr", ROW_LOCAL)
def test_row_local(events, expr):
    assert is_row_local(project(events, [expr]))


@pytest.mark.parametrize("expr", WHOLE_INPUT)
def test_needs_whole_input(events, expr):
    assert growth(project(events, [expr])) == "whole"


@pytest.mark.parametrize("expr", PARTITIONED)
def test_partitioned_window_needs_touched_partitions(events, expr):
    projected = project(events, [expr])
    assert growth(projected) == "parts" and window_keys(projected) == ["user_id"] and not is_row_local(projected)


@pytest.mark.parametrize("expr", STATE)
def test_aggregate_goes_on_from_state(events, expr):
    assert growth(project(events, [expr], "value > 1")) == "state"


def test_python_aggregate_needs_whole_input(spark, events):
    def largest(values: pd.Series) -> float:
        return float(values.max())

    spark.udf.register("pmax", F.pandas_udf(largest, "double"))
    assert growth(project(events, ["pmax(value) AS m"])) == "whole"


def test_where_counts_too(events):
    assert not is_row_local(project(events, ["event_id"], "value > (SELECT max(id) FROM range(5))"))
    assert is_row_local(project(events, [], "value > 5"))


def test_project(spark, events):
    assert project(events, []).columns == events.columns
    with pytest.raises(TypeError):
        project(events, "event_id")
    spark.udf.register("shout", lambda s: s.upper() + "!")
    assert project(events, ["shout(event_type) AS s"], "event_id = 0").first().s == "ERROR!"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project(events, ["CAST(event_type AS INT) AS i"]).collect()
    assert project(events, ["try_cast(event_type AS INT) AS i"]).where("i IS NOT NULL").isEmpty()


def test_projection_and_filter_reach_the_scan(events):
    text = project(events, ["event_id"], "user_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,7)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_select_columns(events):
    assert select_columns(events, "value", "event_id").columns == ["value", "event_id"]
    with pytest.raises(NoSuchColumnError) as caught:
        select_columns(events, "nope", "value", "neither")
    assert caught.value.names == ["nope", "neither"]


def test_matches(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "t"), (3, "b", None)], "id int, k string, t string")
    assert rows(df.where(matches(equal={"k": "a"}, null=["t"])).select("id")) == [(1,)]
    assert rows(df.where(matches(either={"id": 3, "k": "a"})).select("id")) == [(1,), (2,), (3,)]
    assert rows(df.where(matches()).select("id")) == [(1,), (2,), (3,)]


def test_constraints(spark):
    schema = [
        {"column_name": "a", "column_type": "integer", "nullable": False, "primary_key": True},
        {"column_name": "b", "column_type": "integer", "nullable": True, "primary_key": True},
        {"column_name": "c", "column_type": "string", "nullable": False},
        {"column_name": "d", "column_type": "string", "nullable": True},
    ]
    data = [(1, 1, "x", None), (1, 1, "y", None), (1, 2, None, None), (2, None, "z", "q")]
    found = check_constraints(spark.createDataFrame(data, "a int, b int, c string, d string"), schema)
    assert rows(found.nulls.select("a", "b")) == [(1, 2), (2, None)]
    assert rows(found.duplicates) == [(1, 1, 2)]
    assert null_violations(found.nulls, []).isEmpty()


NAMES = [
    ("t1", "p", "x", None),
    ("t2", "p", "y", None),
    ("t3", "p", "y", None),
    ("y", "p", "q", None),
    ("t4", "p", "w", "2024-01-01"),
]


def named(spark, data):
    return spark.createDataFrame(data, "id string, parent string, name string, tombstone string")


def test_resolve_id(spark):
    df = named(spark, NAMES)
    find = {"parent": "p", "parent_column": "parent"}
    assert related.resolve_id(df, "x", **find) == "t1"
    assert related.resolve_id(df, "t2", **find) == "t2"
    assert related.resolve_id(df, "y", **find) == "y"
    with pytest.raises(related.NotFoundError):
        related.resolve_id(df, "w", **find)
    with pytest.raises(related.NotFoundError):
        related.resolve_id(df, "x", parent="other", parent_column="parent")
    with pytest.raises(related.AmbiguousNameError):
        related.resolve_id(df.where("id <> 'y'"), "y", **find)


def test_resolve_labels_agrees_with_single_form(spark):
    df = named(spark, [r for r in NAMES if r[0] != "y"] + [("same", "p", "same", None), ("n", "p", None, None)])
    asked = spark.createDataFrame([("p", label) for label in ["x", "t2", "y", "w", "same", "n", "x"]], "parent string, label string")
    assert rows(related.resolve_labels(asked, df, parent_column="parent")) == [
        ("p", "n", "n", "found"),
        ("p", "same", "same", "found"),
        ("p", "t2", "t2", "found"),
        ("p", "w", None, "missing"),
        ("p", "x", "t1", "found"),
        ("p", "y", None, "ambiguous"),
    ]
    one_by_one = related.resolve_label_stream(asked.withColumn("ID", F.lit(1)), df, parent_column="parent").drop("ID")
    assert rows(one_by_one.distinct()) == rows(related.resolve_labels(asked, df, parent_column="parent"))
    assert one_by_one.count() == 7
    nothing = spark.createDataFrame([("p", None), (None, "x")], "parent string, label string")
    assert {r["outcome"] for r in related.resolve_label_stream(nothing, df, parent_column="parent").collect()} == {"missing"}
    with pytest.raises(ValueError, match="outcome"):
        related.resolve_label_stream(asked.withColumn("OUTCOME", F.lit(1)), df, parent_column="parent")
    found = related.find_labels(asked, df, parent_column="parent")
    assert rows(found.select("label", "id")) == [
        ("n", "n"), ("same", "same"), ("t2", "t2"), ("x", "t1"), ("y", "t2"), ("y", "t3"),
    ]


def test_lookups_skip_deleted_rows(spark):
    df = named(spark, NAMES)
    assert related.get_by_key(df, "t4").isEmpty()
    assert rows(related.get_by_key(df, "t1").select("name")) == [("x",)]
    assert related.list_children(df, "p", parent_column="parent").count() == 4
    assert rows(related.find_by_id_or_name(df, "y", parent="p", parent_column="parent").select("id")) == [
        ("t2",), ("t3",), ("y",),
    ]


def test_related_rows_keep_childless_parents(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    children = spark.createDataFrame([(10, 1), (11, 1), (12, 9)], "child int, of int")
    found = related.related_rows(parents, "id", {"children": (children, "of")})
    assert rows(found.select("parent", "group", "name", "child")) == [
        (1, "children", None, 10), (1, "children", None, 11), (1, "self", "a", None), (2, "self", "b", None),
    ]


def test_related_rows_with_names_of_their_own(spark):
    parents = spark.createDataFrame([(1, "a")], "id int, group string")
    children = spark.createDataFrame([(10, 1)], "child int, parent int")
    found = related.related_rows(parents, "id", {"c": (children, "parent")}, parent_as="_parent", group_as="_group")
    assert rows(found.select("_parent", "_group", "group", "child")) == [(1, "c", None, 10), (1, "self", "a", None)]


def test_to_records_refuses_to_cut(spark):
    df = spark.range(5).select("id", F.lit("x").alias("v"))
    assert related.to_records(df.where("id = 3"), ["v", "id"]) == [{"v": "x", "id": 3}]
    with pytest.raises(related.TooManyRowsError):
        related.to_records(df, limit=4)
    assert len(related.to_records(df, limit=5)) == 5
