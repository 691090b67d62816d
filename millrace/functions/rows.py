"""Rows to text: casts, delimited encoding and keyed records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TEXT = "\\N"
# How quoted text is written and read: outer spaces are part of a value, a quote
# is doubled, and a backslash is left to the escapes below.
QUOTED = {"nullValue": NULL_TEXT, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# What a line can't hold, and how quoted text spells it.  A backslash is doubled.
ESCAPES = {"\n": "\\n", "\r": "\\r"}


def escaped(text: Column) -> Column:
    """Text on one line that is never the sign of NULL: ``unescaped`` gives the text back."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, spelt in ESCAPES.items():
        out = F.replace(out, F.lit(raw), F.lit(spelt))
    return out


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given; NULL is NULL."""

    def plain(part: Column) -> Column:
        for raw, spelt in ESCAPES.items():
            part = F.replace(part, F.lit(spelt), F.lit(raw))
        return part

    # Between two doubled backslashes every other backslash begins an escape.
    whole = F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")
    return F.when(F.contains(text, F.lit("\\")), whole).otherwise(text)


def by_position(df: DataFrame) -> DataFrame:
    """Columns renamed ``_p0, _p1, …`` so repeated names and names with dots can be addressed."""
    return df.toDF(*[f"_p{i}" for i in range(len(df.columns))])


def cast_all_to_string(df: DataFrame) -> DataFrame:
    """Every column as string, with order and names kept."""
    safe = by_position(df)
    return safe.select(*[F.col(c).cast("string").alias(c) for c in safe.columns]).toDF(*df.columns)


def _line(columns: list[str], quoted: bool) -> Column:
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    if quoted:
        return F.to_csv(F.struct(*[escaped(t).alias(c) for t, c in zip(texts, columns, strict=True)]), QUOTED)
    return F.concat_ws(",", *texts)


def encode_rows(df: DataFrame, *, quoted: bool = False) -> DataFrame:
    """One ``value`` column holding each row as comma-delimited text.

    The default joins the columns as they are: NULLs are left out, so later
    fields move left, and a comma inside a field is not protected.
    ``quoted=True`` keeps every value as it is: NULLs apart from empty text and
    from a literal ``\\N``, commas, outer spaces and line breaks.  Scan the
    result with ``quoted=True`` too.  Only ``value`` is returned, so no
    user column can act as a topic sink's routing column.
    """
    safe = by_position(df)
    return safe.select(_line(safe.columns, quoted).alias("value"))


def keyed_records(df: DataFrame, key: str, *, quoted: bool = False) -> DataFrame:
    """``key, value``: the text of one column, and the whole row as delimited text."""
    at = _position(df, key)
    safe = by_position(df)
    return safe.select(
        F.col(safe.columns[at]).cast("string").alias("key"), _line(safe.columns, quoted).alias("value")
    )


def _position(df: DataFrame, name: str) -> int:
    same: list[Callable[[str], bool]] = [lambda c: c == name, lambda c: c.lower() == name.lower()]
    for matches in same:
        found = [i for i, c in enumerate(df.columns) if matches(c)]
        if len(found) == 1:
            return found[0]
        if found:
            raise ValueError(f"key column {name} is ambiguous")
    raise ValueError(f"no such column: {name}")
