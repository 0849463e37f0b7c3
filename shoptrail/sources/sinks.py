"""Batch sinks for finished reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 10) -> None:
    """Append to a database table over at most ``connections`` connections."""
    df.write.option("numPartitions", connections).jdbc(url, table, mode="append", properties=dict(properties))


def append_parquet(df: DataFrame, folder: str) -> None:
    df.write.mode("append").parquet(folder)
