"""Tables that micro-batches keep up to date: one current row per key, in versions of a partition (mostly a day).

``<partition>=x/batch_id=n`` holds all current rows of x as of batch n. A batch reads the last earlier version of the partitions
it touches, merges its rows in and writes version n; older versions than the one it read go. So readers find every key once
and add nothing up, a partition holds two versions at most however many batches there were, and a batch that is delivered
again merges into the same earlier version: its own version is written anew and nothing counts twice. Versions appear
whole, since Spark moves them into place once they are written. Use one table per checkpoint, since batch numbers belong to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.runtime import folders, remove

_NULL = "__HIVE_DEFAULT_PARTITION__"

Merge = dict[str, Callable[[str], Column]]


class CurrentRows:
    """Rows ``(keys, values)`` with one row per key; ``keys`` include the ``partition`` column.

    ``merge`` names for each value how an old and a new one become one, for example ``{"click_count": F.sum}``.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, merge: Merge, partition: str = "date"):
        self.spark, self.folder, self.merge, self.partition = spark, folder, merge, partition
        self.empty = spark.createDataFrame([], schema)
        self.columns = self.empty.columns
        self.schema = f"{schema}, batch_id bigint"

    def _versions(self) -> dict[str, list[int]]:
        found: dict[str, list[int]] = {}
        for path in folders(self.spark, f"{self.folder}/{self.partition}=*/batch_id=*"):
            part, version = path.rstrip("/").split("/")[-2:]
            found.setdefault(part.split("=", 1)[1], []).append(int(version.split("=", 1)[1]))
        return found

    def rows(self, through: int | None = None, parts: Iterable | None = None) -> DataFrame:
        """The current rows, as of batch ``through`` if that is given, of some partitions or of all."""
        wanted = None if parts is None else {_NULL if p is None else str(p) for p in parts}
        paths = []
        for part, versions in self._versions().items():
            known = [v for v in versions if through is None or v <= through]
            if known and (wanted is None or part in wanted):
                paths.append(f"{self.folder}/{self.partition}={part}/batch_id={max(known)}")
        if not paths:
            return self.empty
        reader = self.spark.read.schema(self.schema).option("basePath", self.folder)
        return reader.parquet(*paths).select(*self.columns)

    def _write(self, rows: DataFrame, batch_id: int, parts: Iterable) -> None:
        # Rebalancing cuts a large partition into several files and gives a small one a single file.
        writer = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", F.col(self.partition)).write
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.partition, "batch_id").parquet(self.folder)
        versions = self._versions()
        for part in {_NULL if p is None else str(p) for p in parts}:
            earlier = sorted(v for v in versions.get(part, []) if v < batch_id)
            for version in earlier[:-1]:
                remove(self.spark, f"{self.folder}/{self.partition}={part}/batch_id={version}")

    def parts_of(self, rows: DataFrame) -> list:
        """The partitions that occur in ``rows``: a few days of a batch."""
        return [r[0] for r in rows.select(self.partition).distinct().collect()]

    def add(self, rows: DataFrame, batch_id: int) -> list:
        """Merge a batch's rows into the current ones; returns the partitions that it touched."""
        rows = rows.select(*self.columns).persist()
        try:
            parts = self.parts_of(rows)
            if parts:
                keys = [c for c in self.columns if c not in self.merge]
                both = self.rows(batch_id - 1, parts).unionByName(rows)
                merged = both.groupBy(*keys).agg(*[how(c).alias(c) for c, how in self.merge.items()])
                self._write(merged, batch_id, parts)
            return parts
        finally:
            rows.unpersist()

    def replace(self, rows: DataFrame, batch_id: int, parts: list) -> None:
        """Let ``rows`` be all rows of ``parts``."""
        if parts:
            self._write(rows.select(*self.columns), batch_id, parts)
