"""Declared schemas: the closed type set, validation and conversion to ``StructType``.

A schema is a list of plain dicts, one per column, with the keys
``column_name``, ``column_type``, ``nullable`` and ``primary_key``.  It is
always declared and never inferred from data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import types as T

# The six logical column types and the Spark type each one maps to.
LOGICAL_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "biginteger": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}

Column = dict[str, Any]


class SchemaError(ValueError):
    """A declared schema is not valid; ``errors`` maps column position to messages."""

    def __init__(self, errors: Mapping[Any, list[str]]):
        self.errors = dict(errors)
        super().__init__("; ".join(f"column {at}: {', '.join(found)}" for at, found in self.errors.items()))


def spark_type(logical: str) -> T.DataType:
    """Spark type of one logical type name."""
    if logical not in LOGICAL_TYPES:
        raise SchemaError({logical: [f"unknown type, expected one of {sorted(LOGICAL_TYPES)}"]})
    return LOGICAL_TYPES[logical]


def check_schema(schema: Iterable[Mapping[str, Any]], *, need_key: bool = False) -> list[Column]:
    """Validate a column list and return it with the defaults filled in.

    ``nullable`` defaults to True and ``primary_key`` to False.  Unknown
    attributes, unknown types, wrong value types and repeated names are
    refused, all of them reported at once.
    """
    if isinstance(schema, (str, bytes, Mapping)) or not isinstance(schema, Iterable):
        raise SchemaError({"schema": ["must be a list of columns"]})
    known = {"column_name": str, "column_type": str, "nullable": bool, "primary_key": bool}
    errors: dict[Any, list[str]] = {}
    checked: list[Column] = []
    seen: set[str] = set()
    for position, given in enumerate(schema):
        if not isinstance(given, Mapping):
            errors[position] = ["must be a mapping"]
            continue
        column: Column = {"nullable": True, "primary_key": False, **given}
        found = [f"{name}: unknown attribute" for name in column if name not in known]
        found += [f"{name}: required" for name in ("column_name", "column_type") if name not in column]
        found += [
            f"{name}: must be of type {kind.__name__}"
            for name, kind in known.items()
            if name in column and not isinstance(column[name], kind)
        ]
        logical = column.get("column_type")
        if isinstance(logical, str) and logical not in LOGICAL_TYPES:
            found.append(f"column_type: unallowed value {logical}")
        label = str(column.get("column_name")).lower()
        if label in seen:
            found.append(f"column_name: {column['column_name']} is declared twice")
        seen.add(label)
        if found:
            errors[position] = found
        checked.append({name: column.get(name) for name in known})
    if not errors and need_key and not any(column["primary_key"] for column in checked):
        errors["schema"] = ["at least one primary key column is required"]
    if errors:
        raise SchemaError(errors)
    return checked


def to_struct(schema: Iterable[Mapping[str, Any]]) -> T.StructType:
    """``StructType`` of a column list; a column without ``nullable`` is not nullable."""
    return T.StructType(
        [T.StructField(c["column_name"], spark_type(c["column_type"]), c.get("nullable", False)) for c in schema]
    )


def from_struct(struct: T.StructType, keys: Iterable[str] = ()) -> list[Column]:
    """Column list of a ``StructType`` made of the six types; ``timestamp_ntz`` counts as timestamp."""
    names = {kind.typeName(): logical for logical, kind in LOGICAL_TYPES.items()}
    names[T.TimestampNTZType().typeName()] = "timestamp"
    keys = set(keys)
    errors = {f.name: [f"no logical type for {f.dataType.simpleString()}"] for f in struct if f.dataType.typeName() not in names}
    if errors:
        raise SchemaError(errors)
    return [
        {
            "column_name": f.name,
            "column_type": names[f.dataType.typeName()],
            "nullable": f.nullable and f.name not in keys,
            "primary_key": f.name in keys,
        }
        for f in struct
    ]


def key_columns(schema: Iterable[Mapping[str, Any]]) -> list[str]:
    return [c["column_name"] for c in schema if c.get("primary_key")]


def required_columns(schema: Iterable[Mapping[str, Any]]) -> list[str]:
    """Columns that may not be NULL: NOT NULL ones and every key column."""
    return [c["column_name"] for c in schema if c.get("primary_key") or not c.get("nullable", False)]


def to_json(schema: Iterable[Mapping[str, Any]]) -> str:
    return json.dumps(list(schema), indent=1)


def from_json(text: str) -> list[Column]:
    return check_schema(json.loads(text))
