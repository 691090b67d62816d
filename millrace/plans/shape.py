"""How a projection can be kept up to date while its dataset grows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

# Names of analyzed-plan nodes and expressions.  The first two make a
# row's result depend on other rows.  An aggregate among simple nodes can be kept
# as state.  Streams refuse the unstreamable ones.
AGGREGATE = "Aggregate"
WINDOW = "Window"
SIMPLE_NODES = {AGGREGATE, "Project", "Filter", "SubqueryAlias"}
WINDOWED_NODES = {WINDOW, "Project", "Filter", "SubqueryAlias"}
UNSTREAMABLE = {"monotonically_increasing_id", "PythonUDAF"}

# Each row by itself; a running state of all rows; the window partitions that new
# rows belong to; or all rows again.
ROWS, STATE, PARTS, WHOLE = "rows", "state", "parts", "whole"


def _walk(node) -> Iterator:
    """A plan node or expression and everything below it."""
    pending = [node]
    while pending:
        found = pending.pop()
        yield found
        children = found.children()
        pending.extend(children.apply(i) for i in range(children.size()))


def _parts(node) -> Iterator:
    """Every expression of a plan node, with what it is made of."""
    expressions = node.expressions()
    for i in range(expressions.size()):
        yield from _walk(expressions.apply(i))


def _streamable(nodes: list) -> bool:
    """Whether no expression is of a kind that streams refuse: row numbering, distinct or Python aggregates."""
    for part in (part for node in nodes for part in _parts(node)):
        if part.nodeName() in UNSTREAMABLE or (part.nodeName() == "AggregateExpression" and part.isDistinct()):
            return False
    return True


def window_keys(df: DataFrame) -> list[str]:
    """Input columns that every window of a projection is partitioned by; none if rows of other values may matter.

    A window's rows then all have the same values in these columns, so the
    projection of the rows with some of the values is the same with or without
    the others.  Partitions by an expression only narrow a window further.
    """
    plan = df._jdf.queryExecution().analyzed()
    nodes = list(_walk(plan))
    inner = {node.nodeName() for node in nodes if not node.children().isEmpty()}
    windows = [node for node in nodes if node.nodeName() == WINDOW]
    if not windows or not plan.subqueriesAll().isEmpty() or not inner <= WINDOWED_NODES or not _streamable(nodes):
        return []
    output = plan.collectLeaves().head().output()
    names = {output.apply(i).exprId().id(): output.apply(i).name() for i in range(output.size())}
    common = set(names)
    for node in windows:
        keys = node.partitionSpec()
        keys = [keys.apply(i) for i in range(keys.size())]
        common &= {k.exprId().id() for k in keys if k.nodeName() == "AttributeReference"}
    return [names[k] for k in sorted(common)]


def growth(df: DataFrame) -> str:
    """What it takes to follow a growing input: ``rows``, ``state``, ``parts`` or ``whole``.

    Looks at the node names of the analyzed plan, never at its text.  Without
    an aggregate, window or subquery, new rows can be evaluated alone.  A plain
    aggregate can be continued from its state.  Windows that are partitioned by
    a column need the rows with the values of new rows.  Anything else has to
    see the whole input again.
    """
    plan = df._jdf.queryExecution().analyzed()
    if not plan.subqueriesAll().isEmpty():
        return WHOLE
    nodes = list(_walk(plan))
    names = [node.nodeName() for node in nodes]
    if not _streamable(nodes):
        return WHOLE
    if AGGREGATE not in names and WINDOW not in names:
        return ROWS
    if window_keys(df):
        return PARTS
    inner = {node.nodeName() for node in nodes if not node.children().isEmpty()}
    return STATE if inner <= SIMPLE_NODES and names.count(AGGREGATE) == 1 else WHOLE


def is_row_local(df: DataFrame) -> bool:
    """Whether each input row's result depends on that row alone."""
    return growth(df) == ROWS
