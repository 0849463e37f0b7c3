"""Stratified session sample: each hour is drawn in proportion to its share of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.runtime import stored


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per day and hour, with the day's total. At most 24 rows a day reach the window."""
    start = F.col("start_time")
    counts = sessions.groupBy(C.day_of(start).alias("date"), C.hour_of(start).alias("hour")).agg(
        F.count(F.lit(1)).alias("sessions")
    )
    return counts.withColumn("day_sessions", F.sum("sessions").over(Window.partitionBy("date")))


def _days(counts: DataFrame) -> Column:
    """The number of days, from an aggregate of its own."""
    return counts.select(F.count_distinct("date").alias("days")).scalar()


def with_day_count(counts: DataFrame) -> DataFrame:
    """Hour counts with the number of days."""
    return counts.withColumn("days", _days(counts))


#: Leading hexadecimal digits of the seeded hash that name the cells of an hour: 4,096 of them.
CELL_DIGITS = 3


def draw(sessions: DataFrame, size: int, seed: int) -> DataFrame:
    """Draw about ``size`` sessions without replacement, the same ones for the same seed: ids, date and hour.

    An hour gets ``floor(its share of the day * floor(size / days))`` sessions, those with the lowest seeded
    hash. Counts per hour and cell of hashes show the cell in which the quota ends; sessions in the cells before it are
    drawn as they are, those of later cells never leave the scan's stage, and only within a cell are sessions ranked. So a
    window holds a 4,096th of an hour, however many sessions the hour has.
    """
    start = F.col("start_time")
    lean = sessions.select(
        C.day_of(start).alias("date"),
        C.hour_of(start).alias("hour"),
        "session_id",
        F.md5(F.concat_ws(":", F.lit(str(seed)), "session_id")).alias("draw"),
    ).withColumn("cell", F.left("draw", F.lit(CELL_DIGITS)))
    cells = stored(lean.groupBy("date", "hour", "cell").agg(F.count(F.lit(1)).alias("n")), "cell-counts")
    counts = cells.groupBy("date", "hour").agg(F.sum("n").alias("sessions"))
    counts = stored(counts.withColumn("day_sessions", F.sum("sessions").over(Window.partitionBy("date"))), "hour-counts")
    share = F.col("sessions").cast("double") / F.col("day_sessions")
    quota = F.least(F.col("sessions"), (share * F.floor(F.lit(size) / _days(counts))).cast("bigint"))
    upto = F.sum("n").over(Window.partitionBy("date", "hour").orderBy("cell"))
    cuts = cells.withColumn("before", upto - F.col("n")).join(counts.select("date", "hour", quota.alias("quota")), ["date", "hour"])
    cuts = stored(cuts.where("before < quota").select("date", "hour", "cell", (F.col("quota") - F.col("before")).alias("wanted")), "cuts")
    within = Window.partitionBy("date", "hour", "cell").orderBy("draw", "session_id")
    ranked = lean.join(cuts, ["date", "hour", "cell"]).withColumn("rank", F.row_number().over(within))
    return ranked.where(F.col("rank") <= F.col("wanted")).select("date", "hour", "session_id")


def extract(drawn: DataFrame, details: DataFrame) -> DataFrame:
    """The drawn sessions with start, keywords and categories, which ``details`` has for these or more sessions."""
    shown = details.select("session_id", "start_time", "search_keywords", "click_category_ids")
    return drawn.join(shown, "session_id").select(
        "date", "hour", "session_id", "start_time", "search_keywords", "click_category_ids"
    )
