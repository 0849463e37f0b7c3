"""Parameters of one analysis task."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_JSON_SCHEMA = (
    "startDate string, endDate string, startAge string, endAge string, professionals string, "
    "cities string, sex string, keywords string, categoryIds string, targetPageFlow string"
)


def _items(text: str | None) -> tuple[str, ...]:
    return tuple(part for part in (text or "").split(",") if part)


def _number(text: str | None) -> int | None:
    return int(text) if text else None


@dataclasses.dataclass(frozen=True)
class TaskParams:
    """What one task selects and how it reports.

    An empty string, empty tuple or ``None`` means "no condition". The age condition needs both bounds.
    """

    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    page_flow: tuple[int, ...] = ()
    sample_size: int = 100
    blacklist_threshold: int = 100
    top_categories: int = 10
    top_sessions: int = 10
    top_products: int = 3
    top_ads: int = 3
    seed: int = 42
    task_id: str = dataclasses.field(default_factory=lambda: str(uuid.uuid4()))

    def replace(self, **changes) -> TaskParams:
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_json(cls, spark: SparkSession, text: str, **extra) -> TaskParams:
        """Read the JSON task description; field names may be unquoted."""
        parsed = F.from_json(F.lit(text), _JSON_SCHEMA, {"allowUnquotedFieldNames": "true"})
        row = spark.range(1).select(parsed.alias("p")).first()["p"]
        if row is None or not row["startDate"] or not row["endDate"]:
            raise ValueError("task description needs startDate and endDate")
        return cls(
            start_date=row["startDate"],
            end_date=row["endDate"],
            start_age=_number(row["startAge"]),
            end_age=_number(row["endAge"]),
            professionals=_items(row["professionals"]),
            cities=_items(row["cities"]),
            sex=row["sex"] or None,
            keywords=_items(row["keywords"]),
            category_ids=tuple(int(i) for i in _items(row["categoryIds"])),
            page_flow=tuple(int(i) for i in _items(row["targetPageFlow"])),
            **extra,
        )
