"""Column expressions shared by the operators. All are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to timestamp; the hour may have one digit. Unreadable text gives null."""
    return text.try_cast("timestamp")


def day_of(ts: Column) -> Column:
    """``yyyy-MM-dd``, by a cast, which costs far less per row than formatting."""
    return ts.cast("date").cast("string")


def hour_of(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def time_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a time in whole seconds."""
    return ts.cast("string")


def date_hour(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH")


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def id_list(text: Column) -> Column:
    """Comma-separated ids to ``array<bigint>``; items that are not numbers are left out."""
    return F.array_compact(F.transform(F.split(text, ","), lambda item: item.try_cast("bigint")))


def joined(values: Column) -> Column:
    """Array to comma text, null when the array is empty."""
    return F.nullif(F.array_join(values, ","), F.lit(""))


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole`` as double, rounded half up when ``digits`` is given; null for a zero whole."""
    quotient = F.try_divide(part.cast("double"), whole.cast("double"))
    return quotient if digits is None else F.round(quotient, digits)


def json_field(text: Column, field: str) -> Column:
    return F.get_json_object(text, f"$.{field}")
