"""Soft delete, lookups by id or name, and related rows.

These work on any keyed DataFrame; the catalog is one user of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.project import matches, named, select_columns

TOMBSTONE = "tombstone"


class NotFoundError(LookupError):
    """No live row has the given id or name."""


class AmbiguousNameError(LookupError):
    """Several live rows have the given name and none has it as its id."""


class TooManyRowsError(ValueError):
    """More rows than may be returned to the driver."""


def live_rows(df: DataFrame, tombstone: str = TOMBSTONE) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.where(named(tombstone).isNull())


def get_by_key(df: DataFrame, value: Any, *, key: str = "id", tombstone: str = TOMBSTONE) -> DataFrame:
    """The live row with this key, or no row."""
    return live_rows(df.where(matches(equal={key: value})), tombstone)


def list_children(df: DataFrame, parent: Any, *, parent_column: str, tombstone: str = TOMBSTONE) -> DataFrame:
    """Live rows that belong to a parent."""
    return live_rows(df.where(matches(equal={parent_column: parent})), tombstone)


def _reads(df: DataFrame, column: str, label: Any) -> Column:
    """Whether the text of a column is ``label``.

    A label that the column's type can hold is compared as such too, which
    reaches the scan; one that it can't hold is no match, not an error.
    """
    text, kind = F.lit(str(label)), df.select(named(column)).schema[0].dataType
    if kind.typeName() == "string":
        return named(column) == text
    return (named(column) == text.try_cast(kind)) & (named(column).cast("string") == text)


def find_by_id_or_name(
    df: DataFrame,
    label: Any,
    *,
    parent: Any = None,
    parent_column: str | None = None,
    id_column: str = "id",
    name_column: str = "name",
    tombstone: str = TOMBSTONE,
) -> DataFrame:
    """Live rows whose id or name, as text, is ``label``, within one parent if one is given."""
    within = matches(equal={parent_column: parent} if parent_column else None)
    return live_rows(df.where(within & (_reads(df, id_column, label) | _reads(df, name_column, label))), tombstone)


def _labelled(df: DataFrame, id_column: str, name_column: str, label: str) -> DataFrame:
    """Each row once for its id and once for its name, so that both match by equality."""
    both = F.array_distinct(F.array(named(id_column).cast("string"), named(name_column).cast("string")))
    return df.withColumn(label, F.explode(both)).where(named(label).isNotNull())


def find_labels(
    requests: DataFrame,
    df: DataFrame,
    *,
    parent_column: str,
    label_column: str = "label",
    id_column: str = "id",
    name_column: str = "name",
    tombstone: str = TOMBSTONE,
) -> DataFrame:
    """:func:`find_by_id_or_name` for a whole column of ``(parent, label)`` requests."""
    found = _labelled(live_rows(df, tombstone), id_column, name_column, label_column)
    return requests.select(named(parent_column), named(label_column)).distinct().join(found, [parent_column, label_column])


def resolve_labels(
    requests: DataFrame,
    df: DataFrame,
    *,
    parent_column: str,
    label_column: str = "label",
    id_column: str = "id",
    name_column: str = "name",
    tombstone: str = TOMBSTONE,
) -> DataFrame:
    """Resolve a whole column of ids or names: ``parent, label, id, outcome``.

    One live match gives its id.  Several give the label itself if it is the id
    of one of them, and are ``ambiguous`` otherwise; no match is ``missing``.
    Ids are keys, so they are matched as they are.  Rows are counted per name
    before the join: a name shared by very many rows reaches it as one row.
    """
    asked = requests.select(named(parent_column), named(label_column)).distinct()
    rows = _resolved(asked, df, parent_column, label_column, id_column, name_column, tombstone)
    return rows.select(named(parent_column), named(label_column), F.col("_resolved").alias("id"), F.col("_outcome").alias("outcome"))


def resolve_label_stream(
    requests: DataFrame,
    df: DataFrame,
    *,
    parent_column: str,
    label_column: str = "label",
    id_column: str = "id",
    name_column: str = "name",
    tombstone: str = TOMBSTONE,
    id_as: str = "resolved_id",
    outcome_as: str = "outcome",
) -> DataFrame:
    """Every row of a stream of requests, repeats included, with the id its label stands for and the outcome.

    The rules are those of :func:`resolve_labels`.  ``df`` is static: its labels are counted and joined in each micro-batch,
    and the stream keeps no state.  A label or parent that is NULL is ``missing``.
    """
    clash = {id_as.lower(), outcome_as.lower()} & {c.lower() for c in requests.columns}
    if clash or id_as.lower() == outcome_as.lower():
        raise ValueError(f"the requests have these columns already: {', '.join(sorted(clash)) or id_as}")
    rows = _resolved(requests, df, parent_column, label_column, id_column, name_column, tombstone)
    return rows.select(*[named(c) for c in requests.columns], F.col("_resolved").alias(id_as), F.col("_outcome").alias(outcome_as))


def _resolved(
    asked: DataFrame, df: DataFrame, parent_column: str, label_column: str, id_column: str, name_column: str, tombstone: str
) -> DataFrame:
    """The requests with ``_resolved`` and ``_outcome``."""
    rows = live_rows(df, tombstone).select(
        named(parent_column),
        named(id_column).cast("string").alias("_id"),
        named(name_column).cast("string").alias("_name"),
    )
    by_id = rows.select(named(parent_column), F.col("_id").alias(label_column), F.lit(1).alias("_exact"))
    by_name = (
        # A row that has its id as its name counts once, by its id.
        rows.where("_name IS NOT NULL AND _name <> _id")
        .groupBy(named(parent_column), F.col("_name").alias(label_column))
        .agg(F.count(F.lit(1)).alias("_named"), F.min("_id").alias("_first"))
    )
    joined = asked.join(by_name, [parent_column, label_column], "left").join(by_id, [parent_column, label_column], "left")
    exact, count = F.col("_exact").isNotNull(), F.coalesce("_named", F.lit(0))
    outcome = F.when(exact | (count == 1), "found").when(count == 0, "missing").otherwise("ambiguous")
    resolved = F.when(exact, named(label_column)).when(count == 1, F.col("_first"))
    return joined.withColumns({"_resolved": resolved, "_outcome": outcome})


def resolve_id(df: DataFrame, label: str, *, id_column: str = "id", **find: Any) -> Any:
    """The stored id that one id or name stands for; raises when there is none or no single one."""
    stored = named(id_column)
    summary = (
        find_by_id_or_name(df, label, id_column=id_column, **find)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(stored.cast("string") == F.lit(str(label)), stored)).alias("exact"),
            F.min(stored).alias("only"),
        )
        .first()
    )
    if summary["n"] == 0:
        raise NotFoundError(f"nothing is called {label}")
    if summary["n"] == 1:
        return summary["only"]
    if summary["exact"] is not None:
        return summary["exact"]
    raise AmbiguousNameError(f"{label} names {summary['n']} rows")


def related_rows(
    parents: DataFrame,
    parent_key: str,
    children: Mapping[str, tuple[DataFrame, str]],
    *,
    own: str = "self",
    parent_as: str = "parent",
    group_as: str = "group",
) -> DataFrame:
    """Parents with everything that refers to them, as rows tagged with their group.

    ``children`` maps a group name to a frame and its parent column.  Every
    parent appears in group ``own``; the rows of each other group follow, with
    columns that a group does not have left NULL.  The groups stay rows: a
    parent with very many children is never gathered into one value.
    ``parent_as`` and ``group_as`` name the two tag columns.
    """

    def tagged(frame: DataFrame, key: str, name: str) -> DataFrame:
        return frame.select(named(key).alias(parent_as), F.lit(name).alias(group_as), "*")

    keys = parents.select(named(parent_key).alias(parent_as))
    groups = [tagged(parents, parent_key, own)]
    for name, (frame, column) in children.items():
        groups.append(tagged(frame, column, name).join(keys, parent_as, "left_semi"))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), groups)


def to_records(df: DataFrame, columns: Sequence[str] = (), *, limit: int = 1000) -> list[dict[str, Any]]:
    """A small result as dicts in the given column order; more than ``limit`` rows is an error, never a cut."""
    rows = select_columns(df, *columns).limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooManyRowsError(f"more than {limit} rows; read the DataFrame instead")
    return [row.asDict(recursive=True) for row in rows]
