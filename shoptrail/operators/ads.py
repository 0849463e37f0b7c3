"""Ad clicks: parsing, counts, blacklist and trends. The same transforms serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.operators.ranking import top_per_group
from shoptrail.runtime import stored

USER_AD = ["date", "user_id", "adid"]
PLACE_AD = ["date", "province", "city", "adid"]
MINUTE_AD = ["date", "hour", "minute", "adid"]
MINUTE_MS = 60_000
# Timestamps are microseconds in 64 bits.
MOST_MS = (2**63 - 1) // 1000


def parse(lines: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    """Text lines to typed clicks. Lines with a missing or unreadable field drop out.

    With ``observation`` the numbers of lines and of malformed ones are reported beside the result: by the
    observation or, if it is a name, by a stream's progress.
    Each line is split once: the generator keeps conditions on the fields from being pushed below the
    split, where each would repeat it.
    """
    parts = lines.select(F.col("value").alias("line"), F.explode(F.array(F.split("value", " "))).alias("parts"))

    def field(i: int) -> Column:
        return F.get("parts", F.lit(i))

    fields = parts.select(
        "line",
        field(0).try_cast("bigint").alias("ts_ms"),
        F.nullif(field(1), F.lit("")).alias("province"),
        F.nullif(field(2), F.lit("")).alias("city"),
        field(3).try_cast("bigint").alias("user_id"),
        field(4).try_cast("bigint").alias("adid"),
    )
    needed = ["ts_ms", "province", "city", "user_id", "adid"]
    if observation is not None:
        broken = F.greatest(*[F.col(c).isNull() for c in needed])
        fields = fields.observe(
            observation, F.count(F.lit(1)).alias("lines"), F.count_if(broken).alias("malformed")
        )
    # Times beyond what a timestamp holds keep their ts_ms; only ts and date are null then.
    millis = F.when(F.abs("ts_ms") <= MOST_MS, F.col("ts_ms"))
    clicks = fields.dropna(subset=needed).withColumn("ts", F.timestamp_millis(millis))
    return clicks.withColumn("date", C.day_of(F.col("ts")))


def _counts_per_day(clicks: DataFrame, *keys: str) -> DataFrame:
    """Clicks per day and keys; the day is grouped as a date and only the counted rows get it as text."""
    counted = clicks.groupBy(F.to_date("ts").alias("date"), *keys).agg(F.count(F.lit(1)).alias("click_count"))
    return counted.withColumn("date", F.col("date").cast("string"))


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return _counts_per_day(clicks, "user_id", "adid")


def blacklist(counts: DataFrame, threshold: int) -> DataFrame:
    """Users that clicked any ad more than ``threshold`` times on any day."""
    return counts.where(F.col("click_count") > threshold).select("user_id").distinct()


def without_listed(clicks: DataFrame, listed: DataFrame) -> DataFrame:
    """Clicks of users that are not on the list.

    The list may be long, so it is not forced into a broadcast; Spark checks its size and splits the
    partition of a user with very many clicks. Pass a list that lies in a table: then its size is known
    and a short one spares the clicks their shuffle.
    """
    return clicks.join(listed.select("user_id"), "user_id", "left_anti")


def crossings(clicks: DataFrame, threshold: int) -> DataFrame:
    """Per user the click that takes an ad of a day above ``threshold``, as ``end`` (time and line).

    Counts per minute show in which minute that happens; only the clicks of such minutes are ordered, and of
    each ad only the first ``threshold + 1``. ``copies`` says how often the line of the end counts.
    """
    per_minute = clicks.groupBy(*USER_AD, _minute()).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*USER_AD).orderBy("minute"))
    minutes = per_minute.withColumn("upto", upto).where(
        (F.col("upto") > threshold) & (F.col("upto") - F.col("n") <= threshold)
    )
    minutes = minutes.select(*USER_AD, "minute", (threshold + 1 - F.col("upto") + F.col("n")).alias("needed"))
    first_minute = F.min("minute").over(Window.partitionBy("user_id"))
    minutes = stored(minutes.withColumn("first", first_minute).where("minute = first").drop("first"), "replay-minutes")
    key = [*USER_AD, "minute"]
    in_minute = clicks.select("*", _minute()).join(minutes, key).select(
        *key, "needed", "province", "city", "ts_ms", "line"
    )
    ordered = top_per_group(in_minute, key, [F.asc("ts_ms"), F.asc("line")], threshold + 1)
    same_line = Window.partitionBy(*key, "ts_ms", "line")
    crossing = (
        ordered.where(F.col("rank") <= F.col("needed"))
        .withColumn("copies", F.count(F.lit(1)).over(same_line))
        .where(F.col("rank") == F.col("needed"))
    )
    end = F.min(F.struct("ts_ms", "line", "date", "province", "city", "adid", "copies"))
    return crossing.groupBy("user_id").agg(end.alias("end"))


def replay(clicks: DataFrame, threshold: int) -> DataFrame:
    """Clicks admitted when the blacklist is updated after every single click.

    A user's clicks count up to and including the one that takes an ad of a day above the threshold. Clicks
    are ordered by time, then line. The end points are written out, so that their true size decides how they
    are joined.
    """
    shown = ["date", "province", "city", "user_id", "adid", "ts_ms", "line"]
    ends = stored(crossings(clicks, threshold), "replay-ends")
    before_end = (F.col("ts_ms") < F.col("end.ts_ms")) | (
        (F.col("ts_ms") == F.col("end.ts_ms")) & (F.col("line") < F.col("end.line"))
    )
    limits = ends.select("user_id", F.struct("end.ts_ms", "end.line").alias("end"))
    before = clicks.join(limits, "user_id", "left").where(F.col("end").isNull() | before_end)
    at_end = ends.select("user_id", "end.*").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return before.select(*shown).unionByName(at_end.select(*shown))


def place_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return _counts_per_day(clicks, "province", "city", "adid")


def province_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("date", "province", "adid").agg(F.sum("click_count").alias("click_count"))


def province_top(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads of each day and province, from counts per place."""
    order = [F.desc("click_count"), F.asc("adid")]
    return top_per_group(province_counts(counts), ["date", "province"], order, n)


def _minute() -> Column:
    return F.floor(F.col("ts_ms") / MINUTE_MS).alias("minute")


def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad, by the time of the click. Only the counted rows are formatted."""
    counted = clicks.groupBy(_minute(), "adid").agg(F.count(F.lit(1)).alias("click_count"))
    start = F.timestamp_millis(F.col("minute") * MINUTE_MS)
    return counted.select(
        F.date_format(start, "yyyyMMdd").alias("date"),
        F.date_format(start, "HH").alias("hour"),
        F.date_format(start, "mm").alias("minute"),
        "adid",
        "click_count",
    )


def sliding_counts(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks per ad in every window of ``minutes`` minutes that starts on a full minute."""
    return slide(clicks.groupBy("adid", _minute()).agg(F.count(F.lit(1)).alias("n")), minutes)


def slide(per_minute: DataFrame, minutes: int = 60) -> DataFrame:
    """Sliding counts from counts ``n`` per ad and ``minute`` (since the epoch).

    Each counted minute turns into two changes of a running sum, one where the first window that
    contains it starts and one after the last. An ad has at most two changes per minute of the period,
    however often it was clicked, and nothing is copied into the windows before the sum is known.
    """
    changes = per_minute.select(
        "adid",
        F.inline(
            F.array(
                F.struct((F.col("minute") - (minutes - 1)).alias("start"), F.col("n").alias("change")),
                F.struct((F.col("minute") + 1).alias("start"), (-F.col("n")).alias("change")),
            )
        ),
    )
    by_ad = Window.partitionBy("adid").orderBy("start")
    levels = (
        changes.groupBy("adid", "start")
        .agg(F.sum("change").alias("change"))
        .select(
            "adid",
            "start",
            F.sum("change").over(by_ad).alias("click_count"),
            F.lead("start").over(by_ad).alias("next_start"),
        )
        .where(F.col("click_count") > 0)
    )
    starts = F.sequence(F.col("start"), F.col("next_start") - 1)
    return levels.select("adid", "click_count", F.explode(starts).alias("start")).select(
        F.timestamp_millis(F.col("start") * MINUTE_MS).alias("window_start"), "adid", "click_count"
    )
