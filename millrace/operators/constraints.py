"""NOT NULL and primary-key checks.

A text scan never enforces NOT NULL, whatever its schema says, so tables check
it when they are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.schema import key_columns, required_columns


class Violations(NamedTuple):
    """Rows with a forbidden NULL, and keys held by more than one row."""

    nulls: DataFrame
    duplicates: DataFrame


def lacks(columns: Iterable[str]) -> Column:
    """Whether any of ``columns`` is NULL."""
    return reduce(or_, [F.col(f"`{c}`").isNull() for c in columns], F.lit(False))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of ``columns`` is NULL."""
    return df.where(lacks(columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "n") -> DataFrame:
    """Keys held by more than one row, with their count.

    A count per key is combined before the shuffle, so one key holding most
    rows costs one row per task.
    """
    return (
        df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)
    )


def check_constraints(df: DataFrame, schema: Iterable[Mapping[str, Any]]) -> Violations:
    """What in ``df`` breaks the schema's NOT NULL columns and its primary key."""
    schema = list(schema)
    return Violations(null_violations(df, required_columns(schema)), duplicate_keys(df, key_columns(schema)))


def not_null(column: Column, label: str) -> Column:
    """The column itself; a NULL in it fails the job that evaluates it.

    This puts the check into the pass that writes the rows, in place of a
    second read of the input.
    """
    message = F.lit(f"NOT NULL violated: column {label}")
    return F.when(column.isNull(), F.raise_error(message)).otherwise(column)
