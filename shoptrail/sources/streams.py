"""Streaming sources of ad click lines. Each gives one text column ``value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.runtime import remove_at_exit, work_folder
from shoptrail.sources.tables import EVENTS_SCHEMA, StarSchema, ad_lines_from_events

FILES_PER_BATCH = 1_000
# Parts, and so micro-batches, into which the registered streams cut their input, and rows of a file of a part: a file is one
# task of its batch.
STAGED_PARTS = 6
ROWS_PER_FILE = 50_000


def kafka_lines(spark: SparkSession, brokers: str, topics: str, starting_offsets: str = "latest", **options) -> DataFrame:
    """Lines from Kafka topics. The query's checkpoint keeps the offsets; nothing is committed to Kafka.

    Needs the Kafka connector package on the cluster.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def file_lines(
    spark: SparkSession,
    folder: str,
    fmt: str = "text",
    files_per_batch: int | None = FILES_PER_BATCH,
    bytes_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Lines from files that arrive in a folder, as text or as parquet with a ``value`` column.

    A batch takes a number of files or, with ``bytes_per_batch``, files up to that size. With ``archive``, a folder
    outside of the arriving one, files move there once their batch is done, so that listing the folder stays cheap;
    the checkpoint knows them and none is read again.
    """
    reader = spark.readStream.format(fmt).schema("value string")
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    elif files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def staged_events(spark: SparkSession, folder: str, parts: int = STAGED_PARTS) -> tuple[str, int]:
    """A folder with the ``events`` of the test schema in parts, written one after the other by event id, and files per part.

    File streams take files in order of their modification time, so a stream that takes a part's files at a time meets
    the parts in order. Rows with a null or negative id belong to the first part.
    """
    events = StarSchema(spark, folder).events()
    last = max(events.agg(F.max("event_id")).first()[0] or 0, 0)

    def inside(number: int) -> Column:
        # The ids of part k are those with floor(id * parts / (last + 1)) = k.
        low, high = (-(-k * (last + 1) // parts) for k in (number, number + 1))
        below = F.col("event_id") < high
        return F.coalesce(below, F.lit(True)) if number == 0 else below & (F.col("event_id") >= low)

    # Every part has the same number of files, none of them empty, so that a batch of so many files is a part.
    fewest = min(events.agg(*[F.count_if(inside(k)) for k in range(parts)]).first())
    files = max(1, fewest // ROWS_PER_FILE)
    staged = work_folder(spark, "staged-events")
    for number in range(parts):
        events.where(inside(number)).repartition(files).write.mode("append").parquet(staged)
    remove_at_exit(spark, staged)
    return staged, files


def star_schema_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ad click lines derived from the ``events`` table of the test schema, as a stream of several micro-batches."""
    staged, files = staged_events(spark, folder)
    events = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files).parquet(staged)
    return ad_lines_from_events(events, StarSchema(spark, folder).nation_regions())
