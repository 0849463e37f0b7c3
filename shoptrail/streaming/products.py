"""The advertising statistics as Structured Streaming queries over ad click lines.

Most streams keep no state: they merge each batch's counts into tables of current rows (``sinks.CurrentRows``), so late clicks
count and a batch that is delivered again changes nothing. ``running_place_counts`` and ``sliding_counts`` keep theirs as state instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoptrail.functions import bitmaps
from shoptrail.operators import ads
from shoptrail.runtime import remove_at_exit, work_folder
from shoptrail.sources.streams import star_schema_lines
from shoptrail.streaming.sinks import CurrentRows

PLACE_SCHEMA = "date string, province string, city string, adid bigint, click_count bigint"
MINUTE_SCHEMA = "date string, hour string, minute string, adid bigint, click_count bigint"
USER_AD_SCHEMA = "date string, user_id bigint, adid bigint, click_count bigint"
WINDOW_SCHEMA = "date string, window_start timestamp, adid bigint, click_count bigint"
TOP_SCHEMA = "date string, province string, adid bigint, click_count bigint, rank bigint"
LISTED_SCHEMA = f"shard int, {bitmaps.SCHEMA}"
#: Partitions of the blacklist, of which a batch rewrites those with new users.
LIST_SHARDS = 16

BatchWriter = Callable[[DataFrame, int], None]


def start(stream: DataFrame, write: BatchWriter, folder: str, mode: str = "append", interval: str | None = None) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``write``.

    With ``interval`` it runs on, one batch per interval; without, it stops once all input is read.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
    return writer.trigger(**trigger).foreachBatch(write).start()


def _counts(spark: SparkSession, folder: str, name: str, schema: str) -> CurrentRows:
    return CurrentRows(spark, f"{folder}/{name}", schema, {"click_count": F.sum})


def _places(spark: SparkSession, folder: str) -> CurrentRows:
    return _counts(spark, folder, "place_counts", PLACE_SCHEMA)


def _minutes(spark: SparkSession, folder: str) -> CurrentRows:
    return _counts(spark, folder, "minute_counts", MINUTE_SCHEMA)


def _user_ads(spark: SparkSession, folder: str) -> CurrentRows:
    return _counts(spark, folder, "user_ad_counts", USER_AD_SCHEMA)


def _tops(spark: SparkSession, folder: str) -> CurrentRows:
    return _counts(spark, folder, "province_top", TOP_SCHEMA)


def _listed(spark: SparkSession, folder: str) -> CurrentRows:
    """Listed users as bitmaps."""
    return CurrentRows(spark, f"{folder}/blacklist", LISTED_SCHEMA, {"bits": F.bitmap_or_agg}, "shard")


def place_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _places(spark, folder).rows()


def minute_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _minutes(spark, folder).rows()


def user_ad_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _user_ads(spark, folder).rows()


def listed_users(spark: SparkSession, folder: str) -> DataFrame:
    return bitmaps.members(_listed(spark, folder).rows())


def top_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _tops(spark, folder).rows()


def sliding_counts(clicks: DataFrame, lateness: str = "31 days", length: str = "60 minutes", slide: str = "1 minute") -> DataFrame:
    """Clicks per ad and sliding window of click time, as stream state; for update or append mode.

    A batch's clicks are combined before they reach the state, which holds one count per ad and window. Windows leave it
    ``lateness`` past their end; clicks for them are then dropped and reported (``late_rows``). Clicks without a time are in
    no window.
    """
    windows = clicks.withWatermark("ts", lateness).groupBy(F.window("ts", length, slide), "adid")
    return windows.agg(F.count(F.lit(1)).alias("click_count")).select(F.col("window.start").alias("window_start"), "adid", "click_count")


@contextmanager
def _kept(clicks: DataFrame) -> Iterator[DataFrame]:
    """A batch whose clicks are read more than once."""
    clicks = clicks.persist()
    try:
        yield clicks
    finally:
        clicks.unpersist()


def write_place_counts(folder: str) -> BatchWriter:
    def write(clicks: DataFrame, batch_id: int) -> None:
        _places(clicks.sparkSession, folder).add(ads.place_counts(clicks), batch_id)

    return write


def update_province_top(clicks: DataFrame, batch_id: int, folder: str, n: int) -> None:
    """Add a batch's counts per place and rank again the days it touches. All other days stay as they are."""
    places = _places(clicks.sparkSession, folder)
    days = places.add(ads.place_counts(clicks), batch_id)
    _tops(clicks.sparkSession, folder).replace(ads.province_top(places.rows(batch_id, days), n), batch_id, days)


def write_province_top(folder: str, n: int) -> BatchWriter:
    def write(clicks: DataFrame, batch_id: int) -> None:
        update_province_top(clicks, batch_id, folder, n)

    return write


def write_minute_counts(folder: str) -> BatchWriter:
    """Add each batch's counts per minute, so late clicks count as well."""

    def write(clicks: DataFrame, batch_id: int) -> None:
        _minutes(clicks.sparkSession, folder).add(ads.minute_counts(clicks), batch_id)

    return write


def update_blacklist(clicks: DataFrame, batch_id: int, folder: str, threshold: int) -> DataFrame:
    """Filter a batch by the list so far, add up its counts and list new offenders.

    The list is read afresh for each batch. Only what earlier batches listed counts as known, so a batch that is
    delivered again gives the same result. Returns the admitted clicks, which stay lazy.
    """
    spark = clicks.sparkSession
    listed, counts = _listed(spark, folder), _user_ads(spark, folder)
    known = listed.rows(batch_id - 1).select("bucket", "bits")
    admitted = bitmaps.without(clicks, known)
    days = counts.add(ads.user_ad_counts(admitted), batch_id)
    over = counts.rows(batch_id, days).where(F.col("click_count") > threshold).select("user_id")
    new = bitmaps.bitmaps(bitmaps.without(over, known))
    listed.add(new.withColumn("shard", F.pmod("bucket", F.lit(LIST_SHARDS)).cast("int")), batch_id)
    return admitted


def write_blacklist(folder: str, threshold: int) -> BatchWriter:
    def write(clicks: DataFrame, batch_id: int) -> None:
        update_blacklist(clicks, batch_id, folder, threshold)

    return write


def write_everything(folder: str, threshold: int, top_ads: int) -> BatchWriter:
    """All advertising statistics from one pass over the stream."""

    def write(clicks: DataFrame, batch_id: int) -> None:
        with _kept(clicks) as clicks:
            admitted = update_blacklist(clicks, batch_id, folder, threshold)
            update_province_top(admitted, batch_id, folder, top_ads)
            _minutes(clicks.sparkSession, folder).add(ads.minute_counts(admitted), batch_id)

    return write


#: Spark's own state store on disk, whose checkpoints hold the changes of a batch and not the whole state.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB; the session's settings are as before afterwards."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def running_place_counts(clicks: DataFrame, lateness: str = "31 days") -> DataFrame:
    """Clicks per day and place so far, as stream state; for update mode.

    A day leaves the state once the latest click is ``lateness`` past its end; clicks for it are then dropped and reported as
    ``numRowsDroppedByWatermark`` of the query's progress. Clicks without a time have no day and are not counted.
    """
    days = clicks.withWatermark("ts", lateness).groupBy(F.window("ts", "1 day"), "province", "city", "adid")
    return days.agg(F.count(F.lit(1)).alias("click_count"))


def _day(column: str) -> Column:
    return F.date_format(F.col(f"{column}.start"), "yyyy-MM-dd").alias("date")


def write_running_counts(folder: str) -> BatchWriter:
    """Put the rows that a batch changed in place of the earlier ones; counts only grow, so the larger is the later."""

    def write(changed: DataFrame, batch_id: int) -> None:
        table = CurrentRows(changed.sparkSession, f"{folder}/running_counts", PLACE_SCHEMA, {"click_count": F.max})
        table.add(changed.select(_day("window"), "province", "city", "adid", "click_count"), batch_id)

    return write


def running_totals(spark: SparkSession, folder: str) -> DataFrame:
    return CurrentRows(spark, f"{folder}/running_counts", PLACE_SCHEMA, {"click_count": F.max}).rows()


def state_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The counts that the state of ``running_place_counts`` holds after its last batch, to look one up or to compare all."""
    state = spark.read.format("statestore").load(f"{folder}/checkpoint")
    return state.select(_day("key.window"), "key.province", "key.city", "key.adid", F.col("value.count").alias("click_count"))


def start_running_counts(clicks: DataFrame, folder: str, lateness: str = "31 days", interval: str | None = None) -> StreamingQuery:
    """Keep running counts below ``folder``; starting again there goes on from the state of the last finished batch."""
    with state_on_disk(clicks.sparkSession):
        return start(running_place_counts(clicks, lateness), write_running_counts(folder), folder, "update", interval)


def _windows(spark: SparkSession, folder: str) -> CurrentRows:
    return CurrentRows(spark, f"{folder}/sliding_counts", WINDOW_SCHEMA, {"click_count": F.max})


def write_sliding_counts(folder: str) -> BatchWriter:
    """Put the windows that a batch changed in place of the earlier ones; counts only grow, so the larger is the later."""

    def write(changed: DataFrame, batch_id: int) -> None:
        day = F.date_format("window_start", "yyyy-MM-dd").alias("date")
        _windows(changed.sparkSession, folder).add(changed.select(day, "window_start", "adid", "click_count"), batch_id)

    return write


def window_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder).rows().drop("date")


def start_sliding_counts(
    clicks: DataFrame, folder: str, lateness: str = "31 days", length: str = "60 minutes", interval: str | None = None
) -> StreamingQuery:
    """Keep sliding counts below ``folder``; starting again there goes on from the state of the last finished batch."""
    with state_on_disk(clicks.sparkSession):
        return start(sliding_counts(clicks, lateness, length), write_sliding_counts(folder), folder, "update", interval)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late for the state, over the batches whose progress Spark still keeps.

    A row is what reaches the state: the clicks of a batch that share a window, ad and task are one.
    """
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def _run(spark: SparkSession, tables: str, purpose: str, writer: Callable[[str], BatchWriter], listed: DataFrame | None = None) -> str:
    """Run the stream over the test tables to its end; returns the folder of its results."""
    folder = work_folder(spark, purpose)
    clicks = ads.parse(star_schema_lines(spark, tables))
    if listed is not None:
        clicks = ads.without_listed(clicks, listed)
    start(clicks, writer(folder), folder).awaitTermination()
    remove_at_exit(spark, folder)
    return folder


def place_counts(spark: SparkSession, tables: str, listed: DataFrame) -> DataFrame:
    return place_totals(spark, _run(spark, tables, "place-counts", write_place_counts, listed))


COUNTER_SCHEMA = "batch_id bigint, lines bigint, malformed bigint, filtered bigint"


def counters(query: StreamingQuery) -> list[tuple[int, int, int, int]]:
    """Per batch with input, of those whose progress Spark still keeps: lines, malformed ones, and clicks of listed users."""
    found = {}
    for progress in query.recentProgress:
        seen = progress["observedMetrics"]
        if progress["numInputRows"] and "read" in seen and "admitted" in seen:
            read, admitted = seen["read"], seen["admitted"]["clicks"]
            found[progress["batchId"]] = (read["lines"], read["malformed"], read["lines"] - read["malformed"] - admitted)
    return [(batch, *counted) for batch, counted in sorted(found.items())]


def counted_clicks(lines: DataFrame, listed: DataFrame) -> DataFrame:
    """Clicks of users that are not on a list of bitmaps, counted on the way."""
    return bitmaps.without(ads.parse(lines, "read"), listed).observe("admitted", F.count(F.lit(1)).alias("clicks"))


def batch_counters(spark: SparkSession, tables: str, listed: DataFrame) -> DataFrame:
    """The counters of a stream over the test tables that keeps the minute trend."""
    folder = work_folder(spark, "counters")
    query = start(counted_clicks(star_schema_lines(spark, tables), listed), write_minute_counts(folder), folder)
    query.awaitTermination()
    remove_at_exit(spark, folder)
    return spark.createDataFrame(counters(query), COUNTER_SCHEMA)


def run_running_counts(spark: SparkSession, tables: str, listed: DataFrame) -> str:
    """Run the stateful stream over the test tables to its end, without the users of a list of bitmaps; returns its folder."""
    folder = work_folder(spark, "running-counts")
    clicks = bitmaps.without(ads.parse(star_schema_lines(spark, tables)), listed)
    start_running_counts(clicks, folder).awaitTermination()
    remove_at_exit(spark, folder)
    return folder


def run_sliding_counts(spark: SparkSession, tables: str, listed: DataFrame) -> str:
    """Run the stream of sliding windows over the test tables to its end, without the users of a list of bitmaps."""
    folder = work_folder(spark, "sliding-counts")
    clicks = bitmaps.without(ads.parse(star_schema_lines(spark, tables)), listed)
    start_sliding_counts(clicks, folder).awaitTermination()
    remove_at_exit(spark, folder)
    return folder


def province_top(spark: SparkSession, tables: str, listed: DataFrame, n: int) -> DataFrame:
    return top_rows(spark, _run(spark, tables, "province-top", lambda folder: write_province_top(folder, n), listed))


def minute_counts(spark: SparkSession, tables: str, listed: DataFrame) -> DataFrame:
    return minute_totals(spark, _run(spark, tables, "minute-counts", write_minute_counts, listed))


def sliding_hour(spark: SparkSession, tables: str, listed: DataFrame) -> DataFrame:
    """Sliding windows from the stream's minute counts: no window is kept as state, and no click comes too late."""
    totals = minute_totals(spark, _run(spark, tables, "minute-counts", write_minute_counts, listed))
    start_time = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
    minute = F.floor(F.unix_timestamp(start_time) / 60).alias("minute")
    return ads.slide(totals.select("adid", minute, F.col("click_count").alias("n")))


def blacklist(spark: SparkSession, tables: str, threshold: int) -> DataFrame:
    return listed_users(spark, _run(spark, tables, "blacklist", lambda folder: write_blacklist(folder, threshold)))
