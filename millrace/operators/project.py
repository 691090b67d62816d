"""Projection by select expressions, column selection and simple predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class NoSuchColumnError(ValueError):
    """Columns were asked for that do not exist; ``names`` lists them."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)
        super().__init__(f"there is no such column: {', '.join(self.names)}")


def project(df: DataFrame, exprs: Sequence[str] = (), where: str | Column | None = None) -> DataFrame:
    """Apply Spark SQL select expressions; none means every column.

    ``where`` filters the input rows, before the expressions see them.
    """
    if isinstance(exprs, str):
        raise TypeError("give a list of select expressions, not one string")
    if where is not None:
        df = df.where(where)
    return df.selectExpr(*exprs) if exprs else df


def named(name: str) -> Column:
    """The column of this very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns in the order asked for, or all of them; case does not matter, and names come as asked."""
    known = {c.lower() for c in df.columns}
    unknown = [c for c in columns if c.lower() not in known]
    if unknown:
        raise NoSuchColumnError(unknown)
    return df.select(*[named(c).alias(c) for c in columns]) if columns else df


def matches(
    *, equal: Mapping[str, Any] | None = None, null: Sequence[str] = (), either: Mapping[str, Any] | None = None
) -> Column:
    """All of ``equal`` hold, all of ``null`` are NULL, and any one of ``either`` holds."""
    terms = [named(name) == F.lit(value) for name, value in (equal or {}).items()]
    terms += [named(name).isNull() for name in null]
    if either:
        terms.append(reduce(or_, [named(name) == F.lit(value) for name, value in either.items()]))
    return reduce(and_, terms, F.lit(True))
