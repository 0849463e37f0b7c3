"""Tables laid out for later reads: by day, so that days prune; by buckets of the join key, so that joins need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.runtime import remove_at_exit, stored, work_folder
from shoptrail.sources.tables import save_table

#: Rows of a bucket, and rows of one user that share a part.
BUCKET_ROWS, PART_ROWS = 4_000_000, 1_000_000
FEWEST_BUCKETS = 8


def saved_by_date(visits: DataFrame) -> DataFrame:
    """The visit log in one folder per day. Rows are dealt by day and event, so a busy day is written by several tasks."""
    return stored(visits.repartitionByRange("date", "event_id"), "visits-by-date", ("date",))


def of_days(visits: DataFrame, days: DataFrame) -> DataFrame:
    """Visits of the days in a table. Where ``visits`` lie by day, folders of other days are not opened."""
    return visits.join(days.select("date"), "date")


def busy_days(visits: DataFrame) -> DataFrame:
    """Days with more visits than the mean of all days."""
    counts = stored(visits.groupBy("date").agg(F.count(F.lit(1)).alias("visits")), "day-counts")
    return counts.where(F.col("visits") > counts.select(F.avg("visits")).scalar())


def _bucketed(df: DataFrame, buckets: int, keys: list[str]) -> DataFrame:
    spark = df.sparkSession
    name, folder = f"bucketed_{uuid.uuid4().hex}", work_folder(df.sparkSession, "bucketed")
    save_table(df.repartition(buckets, *keys), name, bucket_by=(buckets, *keys), folder=folder)
    remove_at_exit(spark, folder)
    # The plan keeps the layout; the name is not needed any more, and the files of a table with a folder stay.
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def co_located(
    visits: DataFrame, users: DataFrame, part_rows: int = PART_ROWS, bucket_rows: int = BUCKET_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Visits and users as tables in equal buckets of ``(user_id, part)``, which join without a shuffle.

    A user with more than ``part_rows`` visits is dealt over several parts, and so over several buckets; their row of the
    user table is repeated once per part. Users without such a number of visits have part 0 alone. Visits without a
    user are kept. The driver reads one number, the sum of all visits.
    """
    counts = stored(visits.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "visits-per-user")
    total = counts.agg(F.sum("n")).first()[0] or 0
    buckets = max(FEWEST_BUCKETS, -(-total // bucket_rows))
    parts = F.ceil(F.col("n") / part_rows).cast("int").alias("parts")
    large = stored(counts.where(F.col("user_id").isNotNull() & (F.col("n") > part_rows)).select("user_id", parts), "large-users")
    of_visit = F.coalesce(F.pmod(F.xxhash64("event_id"), F.col("parts")), F.lit(0)).cast("int")
    dealt = visits.join(large, "user_id", "left").withColumn("part", of_visit).drop("parts")
    all_parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
    repeated = users.join(large, "user_id", "left").withColumn("part", all_parts).drop("parts")
    keys = ["user_id", "part"]
    return _bucketed(dealt, buckets, keys), _bucketed(repeated, buckets, keys)


def visits_by_profile(visits: DataFrame, users: DataFrame) -> DataFrame:
    """Visits, clicks and purchases per profession, sex and city, from the two tables of ``co_located``."""
    profile = ["professional", "sex", "city"]
    joined = visits.join(users.select("user_id", "part", *profile), ["user_id", "part"])
    return joined.groupBy(*profile).agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_if(F.col("click_category_id") != -1).alias("clicks"),
        F.count("pay_category_ids").alias("purchases"),
    )
