"""Column references that survive dots and quotes in names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(df: DataFrame) -> list[Column]:
    return [quoted(c) for c in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """``name`` or, where the table has such a column, a name like it that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
