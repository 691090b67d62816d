"""Names given to rows: what the row is, then one random id."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_id(kind: str) -> str:
    """``kind-<random id>``."""
    return f"{kind}-{uuid4()}"


def new_table_id() -> str:
    """A new table's id, which is a valid SQL name as it stands."""
    return f"table_{uuid4().hex}"


def row_id(kind: str) -> Column:
    """A fresh id for every row, of the same form as :func:`new_id`."""
    return F.concat(F.lit(f"{kind}-"), F.uuid())
