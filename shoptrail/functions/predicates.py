"""Optional conditions of a task. Each returns ``None`` when its parameter is absent."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.params import TaskParams


def between(column: Column, low, high) -> Column | None:
    """Inclusive range. A missing bound switches the condition off; a null value fails it."""
    return None if low is None or high is None else column.between(low, high)


def one_of(column: Column, values: Sequence) -> Column | None:
    """Membership in a list. The value ``-1`` stands for "none" and never matches."""
    return column.isin([v for v in values if str(v) != "-1"]) if values else None


def equal(column: Column, value) -> Column | None:
    return None if value in (None, "") else column == value


def keep(df: DataFrame, conditions: Iterable[Column | None]) -> DataFrame:
    """Rows that meet every condition that is present."""
    present = [c for c in conditions if c is not None]
    return df.where(reduce(and_, present)) if present else df


def in_period(df: DataFrame, params: TaskParams, column: str = "date") -> DataFrame:
    """Rows of the task's inclusive date range; ISO dates compare as text, so the scan can prune on it."""
    return df.where(F.col(column).between(params.start_date, params.end_date))


def user_conditions(params: TaskParams) -> list[Column | None]:
    return [
        between(F.col("age"), params.start_age, params.end_age),
        one_of(F.col("professional"), params.professionals),
        one_of(F.col("city"), params.cities),
        equal(F.col("sex"), params.sex),
    ]
