"""Joins on a key that holds most rows: the plans leave room for splitting its partition at run time."""

import pytest
from pyspark.sql import functions as F

from shoptrail.functions import bitmaps
from shoptrail.operators import ads, categories, sessions
from shoptrail.runtime import stored

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture(autouse=True)
def small_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def actions(spark, tmp_path):
    hot = F.col("id") % 3 == 0
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5000)).alias("session_id"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 500).alias("user_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 3000).alias("action_time"),
        F.lit(None).cast("string").alias("search_keyword"),
        (F.hash("id") % 50 + 50).cast("bigint").alias("click_category_id"),
        F.lit(None).cast("string").alias("order_category_ids"),
        F.lit(None).cast("string").alias("pay_category_ids"),
    )
    rows.write.parquet(str(tmp_path / "actions"))
    return spark.read.parquet(str(tmp_path / "actions"))


@pytest.fixture
def clicks(spark, tmp_path):
    user = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    lines = spark.range(0, 60_000, 1, 8).select(
        F.concat_ws(" ", F.col("id") * 1000 + 1_704_067_200_000, F.col("id") % 3, F.hash("id") % 9, user, F.col("id") % 5).alias("value")
    )
    lines.write.parquet(str(tmp_path / "lines"))
    return ads.parse(spark.read.parquet(str(tmp_path / "lines")))


def run(df):
    """Collected rows and the plan that was finally executed."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def test_hot_session_among_filtered_actions_is_split(spark, actions):
    kept = actions.select("session_id").distinct().where("session_id = 'hot' or session_id like 's1%'")
    kept = stored(kept, "sessions")
    counted = categories.counts(sessions.actions_of(actions, kept))
    assert "skew=true" in run(counted)
    expected = actions.where("session_id = 'hot' or session_id like 's1%'").count()
    assert counted.agg(F.sum("click_count")).first()[0] == expected


def test_clicks_of_hot_user_are_split(spark, clicks):
    listed = stored(spark.range(100, 200).toDF("user_id"), "listed")
    counted = ads.place_counts(ads.without_listed(clicks, listed))
    assert "skew=true" in run(counted)
    assert counted.agg(F.sum("click_count")).first()[0] == clicks.where("user_id not between 100 and 199").count()


def test_user_with_most_sessions_is_split(spark, tmp_path):
    owned = spark.range(0, 60_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("session_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("user_id"),
        (F.hash("id") % 2000).cast("bigint").alias("visit_length"),
        (F.hash("id") % 70).cast("bigint").alias("step_length"),
    )
    owned.write.parquet(str(tmp_path / "sessions"))
    users = spark.range(500).selectExpr("id as user_id", "30 as age", "'p' as professional", "'m' as sex", "'c' as city")
    stats = sessions.ratio_stats(sessions.with_users(spark.read.parquet(str(tmp_path / "sessions")), users))
    assert "skew=true" in run(stats)
    assert stats.first().session_count == 60_000


def test_hot_session_reaches_the_session_join_as_counts(spark, actions):
    """Clicks are counted first, so the join sees one row per category and session."""
    popular = categories.top(categories.counts(actions), 10)
    kept = actions.select("session_id").distinct()
    ranked = categories.top_sessions(actions, popular, 1, kept).collect()
    assert {r.session_id for r in ranked} == {"hot"} and len(ranked) == 10


def test_clicks_of_hot_user_are_split_in_the_replay(spark, clicks):
    """A third of the clicks are one user's: the last join cuts them, and no list is broadcast by force."""
    assert "skew=true" in run(ads.replay(clicks, 3_999))


def test_blacklist_replay_with_hot_user(spark, clicks):
    kept = ads.replay(clicks, 50)
    per_user = kept.groupBy("user_id").count().where("user_id = 7").first()
    days = clicks.where("user_id = 7").agg(F.count_distinct("date")).first()[0]
    assert days == 1 and 51 <= per_user["count"] <= 5 * 50 + 1


def test_bitmap_list_with_a_hot_user(spark):
    """A third of the clicks are one user's, who is not listed; the list is joined by shuffle and that user's part is cut."""
    clicks = spark.range(600_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("user_id"), F.col("id").alias("ts_ms"))
    listed = stored(bitmaps.bitmaps(spark.range(100, 200_000, 2).toDF("user_id")), "listed")
    expected = clicks.join(listed_ids(spark), "user_id", "left_anti").count()
    assert bitmaps.without(clicks, listed).count() == expected


def listed_ids(spark):
    return spark.range(100, 200_000, 2).toDF("user_id")
