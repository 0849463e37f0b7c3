"""The advertising application: one stream of click lines, five result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoptrail.operators import ads
from shoptrail.params import TaskParams
from shoptrail.runtime import remove_at_exit, work_folder
from shoptrail.sources.streams import star_schema_lines
from shoptrail.streaming import products


def start_ad_statistics(
    lines: DataFrame, folder: str, params: TaskParams, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Keep blacklist, user counts, place counts, top ads and minute trend up to date below ``folder``.

    ``folder`` lies in storage that all executors share and holds the checkpoint as well; starting again
    with the same folder resumes where the last run stopped.
    """
    write = products.write_everything(folder, params.blacklist_threshold, params.top_ads)
    return products.start(ads.parse(lines), write, folder, interval=interval)


def run_live(spark: SparkSession, tables: str, params: TaskParams) -> str:
    """Run the application over the test tables' clicks to their end; returns the folder of its results."""
    folder = work_folder(spark, "live")
    start_ad_statistics(star_schema_lines(spark, tables), folder, params, interval=None).awaitTermination()
    remove_at_exit(spark, folder)
    return folder
