"""Exact top-n per group that survives one group holding most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def salt_count(spark: SparkSession) -> int:
    """Shards of a hot group: as many as the shuffle has partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (which must be total), with their rank.

    Each group is ranked in shards first and then among the shards' first rows, so no task ever sorts a
    whole hot group, whatever ``n`` is. A shard is made of input partitions, which spreads even a group of
    identical rows.
    """
    sharded = df.withColumn("_shard", F.spark_partition_id() % salt_count(df.sparkSession))
    by_shard = Window.partitionBy(*keys, "_shard").orderBy(*order)
    first = sharded.withColumn("_rank", F.row_number().over(by_shard)).where(F.col("_rank") <= n).drop("_shard", "_rank")
    by_key = Window.partitionBy(*keys).orderBy(*order)
    ranked = first.withColumn(rank, F.row_number().over(by_key)).where(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))
