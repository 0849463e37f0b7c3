"""Batch sources: the shop's own tables, and the same logical tables derived from the test star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.params import TaskParams

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Columns of the star schema that are read; naming them spares the look into the files.
STAR_SCHEMAS = {
    "events": EVENTS_SCHEMA,
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string",
}

# The shop's ten cities with their sales area.
CITY_AREAS = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

# Level of each sales area.
AREA_LEVELS = {
    "华北": "A_Level",
    "华东": "A_Level",
    "华南": "B_Level",
    "华中": "B_Level",
    "西北": "C_Level",
    "西南": "C_Level",
    "东北": "D_Level",
    "其他": "D_Level",
}

# Levels used with the regions of the test tables; the fifth region has none on purpose.
REGION_LEVELS = {"AFRICA": "A_Level", "AMERICA": "A_Level", "ASIA": "B_Level", "EUROPE": "C_Level"}


def city_areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_AREAS, "city_id bigint, city_name string, area string")


def visit_actions(
    spark: SparkSession, table: str = "user_visit_action", observation: Observation | None = None
) -> DataFrame:
    """The visit log of the catalog, with ``action_time`` as timestamp. Rows with an unreadable time drop out.

    With ``observation`` the numbers of rows and of unreadable times are reported beside the result.
    """
    actions = spark.table(table)
    if dict(actions.dtypes)["action_time"] == "string":
        actions = actions.withColumn("action_time", C.parse_time(F.col("action_time")))
    if observation is not None:
        unreadable = F.count_if(F.col("action_time").isNull()).alias("unreadable")
        actions = actions.observe(observation, F.count(F.lit(1)).alias("rows"), unreadable)
    return actions.where(F.col("action_time").isNotNull())


def user_info(spark: SparkSession, table: str = "user_info") -> DataFrame:
    return spark.table(table)


def product_info(spark: SparkSession, table: str = "product_info") -> DataFrame:
    return spark.table(table)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: tuple[str, ...] = (),
    bucket_by: tuple[int | str, ...] = (),
    folder: str | None = None,
) -> None:
    """Replace a catalog table, whatever its former layout.

    ``bucket_by`` is the number of buckets, then the columns. With ``folder`` the files lie there and outlive the table.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
    if folder:
        writer = writer.option("path", folder)
    writer.saveAsTable(name)


class StarSchema:
    """Visit log, users, products, areas and ad click lines derived from the star-schema test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def events(self) -> DataFrame:
        return self._table("events")

    def actions(self, params: TaskParams | None = None, kinds: Sequence[str] = ()) -> DataFrame:
        """The visit log. Period and ``kinds`` of event are conditions on the scanned columns."""
        events = self.events()
        if kinds:
            events = events.where(F.col("event_type").isin(list(kinds)))
        if params is not None:
            first, after = _ntz_day(params.start_date), _ntz_day(params.end_date, plus=1)
            events = events.where((F.col("ts") >= first) & (F.col("ts") < after))
        return actions_from_events(events)

    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        nations = self._table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
        return self._table("customer").join(nations, "c_nationkey").select(
            key.alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("c_name").alias("name"),
            (key % 60).cast("int").alias("age"),
            F.concat(F.lit("professional"), key % 10).alias("professional"),
            "city",
            F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
        )

    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self._table("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.concat(F.lit('{"product_status": '), key % 2, F.lit("}")).alias("extend_info"),
        )

    def areas(self) -> DataFrame:
        regions = self._table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("area"))
        return self._table("nation").join(regions, "n_regionkey").select(
            F.col("n_nationkey").cast("bigint").alias("city_id"), F.col("n_name").alias("city_name"), "area"
        )

    def ad_lines(self) -> DataFrame:
        return ad_lines_from_events(self.events(), self.nation_regions())

    def nation_regions(self) -> DataFrame:
        return self._table("nation").select(F.col("n_nationkey").cast("bigint").alias("city"), "n_regionkey")


def _ntz_day(day: str, plus: int = 0) -> Column:
    date = dt.date.fromisoformat(day) + dt.timedelta(days=plus)
    return F.lit(dt.datetime.combine(date, dt.time())).cast("timestamp_ntz")


def _epoch_day_seconds(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400


def _json_k() -> Column:
    return C.json_field(F.col("props"), "k").cast("bigint")


def actions_from_events(events: DataFrame) -> DataFrame:
    ts, kind, k = F.col("ts"), F.col("event_type"), F.col("k")
    second_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    hour_start = _epoch_day_seconds(ts) + (F.col("user_id") % 24) * 3600
    product = F.col("event_id") % 100
    date = ts.cast("date").cast("string")
    return events.withColumn("k", _json_k()).select(
        "event_id",
        date.alias("date"),
        "user_id",
        F.concat_ws("_", "user_id", date).alias("session_id"),
        (k % 10).alias("page_id"),
        F.timestamp_seconds(hour_start + F.floor(second_of_day / 25)).alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), k % 10)).alias("search_keyword"),
        F.when(kind == "click", k % 20).otherwise(F.lit(-1)).alias("click_category_id"),
        F.when(kind == "click", product).otherwise(F.lit(-1)).alias("click_product_id"),
        F.when(kind == "signup", F.concat_ws(",", k % 20, (k + 1) % 20)).alias("order_category_ids"),
        F.when(kind == "signup", product.cast("string")).alias("order_product_ids"),
        F.when(kind == "purchase", (k % 20).cast("string")).alias("pay_category_ids"),
        F.when(kind == "purchase", product.cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
    )


def ad_lines_from_events(events: DataFrame, nation_regions: DataFrame) -> DataFrame:
    """One text line per event: epoch milliseconds, province, city, user and ad, separated by spaces."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    milli_of_day = F.pmod(millis, F.lit(86_400_000))
    ad_ms = millis - milli_of_day + F.floor(milli_of_day / 24)
    placed = events.withColumn("city", F.col("user_id") % 25).join(nation_regions, "city")
    return placed.select(F.concat_ws(" ", ad_ms, "n_regionkey", "city", "user_id", _json_k() % 5).alias("value"))
