"""One row per key out of many: upsert and insert-if-absent as aggregates.

Both are a ``max`` or ``min`` over one struct that starts with the ordering
columns and ends with all the others.  That makes the winner independent of
arrival order, and lets every task reduce its own rows to one per key before
the shuffle, so a key that holds a third of the input is no hot spot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WINNER = "__winner"


def _one_per_key(df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], pick) -> DataFrame:
    if not keys:
        raise ValueError("at least one key column is needed")
    rest = [c for c in df.columns if c not in keys and c not in sequence_by]
    ordered = [*[c for c in sequence_by if c not in keys], *rest]
    if not ordered:
        return df.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    winner = pick(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(ordered)])).alias(_WINNER)
    at = {c: f"{_WINNER}.c{i}" for i, c in enumerate(ordered)}
    reduced = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(winner)
    return reduced.select(*[F.col(at[c]).alias(c) if c in at else F.col(f"`{c}`") for c in df.columns])


def latest_by_key(df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``sequence_by`` per key; ties go to the greatest of the other columns.

    ``sequence_by`` should hold no NULL: a NULL sorts below everything.
    """
    return _one_per_key(df, keys, sequence_by, F.max)


def first_by_key(df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The row with the least ``sequence_by`` per key: first write wins."""
    return _one_per_key(df, keys, sequence_by, F.min)


def absent_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``existing``."""
    return df.join(existing.select(*[F.col(f"`{k}`") for k in keys]).distinct(), list(keys), "left_anti")
