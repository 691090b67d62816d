import pytest
from pyspark.sql import types as T

from millrace.functions import schema as s

SENSOR = [
    {"column_name": "timestamp", "column_type": "biginteger", "nullable": False, "primary_key": True},
    {"column_name": "my_column", "column_type": "string", "nullable": True},
    {"column_name": "name", "column_type": "string"},
]


def test_types_are_the_six():
    kinds = {n: s.spark_type(n).simpleString() for n in s.LOGICAL_TYPES}
    assert kinds == {
        "string": "string",
        "integer": "int",
        "biginteger": "bigint",
        "boolean": "boolean",
        "double": "double",
        "timestamp": "timestamp",
    }
    with pytest.raises(s.SchemaError):
        s.spark_type("decimal")


def test_check_fills_defaults():
    checked = s.check_schema(SENSOR)
    assert [c["nullable"] for c in checked] == [False, True, True]
    assert [c["primary_key"] for c in checked] == [True, False, False]
    assert s.check_schema([]) == []


def test_check_reports_everything_at_once():
    with pytest.raises(s.SchemaError) as caught:
        s.check_schema(
            [
                {"column_name": "a", "column_type": "decimal"},
                {"column_type": "string", "extra": 1},
                {"column_name": "A", "column_type": "string", "nullable": "yes"},
                "x",
            ]
        )
    errors = caught.value.errors
    assert errors[0] == ["column_type: unallowed value decimal"]
    assert set(errors[1]) == {"extra: unknown attribute", "column_name: required"}
    assert set(errors[2]) == {"nullable: must be of type bool", "column_name: A is declared twice"}
    assert errors[3] == ["must be a mapping"]


def test_table_needs_key():
    with pytest.raises(s.SchemaError):
        s.check_schema(SENSOR[1:], need_key=True)
    with pytest.raises(s.SchemaError):
        s.check_schema("abc")


def test_struct_round_trip():
    checked = s.check_schema(SENSOR)
    struct = s.to_struct(checked)
    assert struct["timestamp"].dataType == T.LongType() and not struct["timestamp"].nullable
    assert s.from_struct(struct, ["timestamp"]) == checked
    assert s.from_json(s.to_json(checked)) == checked
    assert not s.to_struct([{"column_name": "a", "column_type": "string"}])["a"].nullable
    with pytest.raises(s.SchemaError):
        s.from_struct(T.StructType([T.StructField("d", T.DateType())]))


def test_key_and_required_columns():
    assert s.key_columns(SENSOR) == ["timestamp"]
    assert s.required_columns(s.check_schema(SENSOR)) == ["timestamp"]
