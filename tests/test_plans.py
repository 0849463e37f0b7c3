"""Physical plans of the registered queries."""

import pytest

from shoptrail import runtime
from shoptrail.operators import ads, distributions, pageflow, sampling, sessions
from shoptrail.params import TaskParams
from shoptrail.plans import registry
from shoptrail.sources import layouts
from shoptrail.sources.streams import STAGED_PARTS
from shoptrail.sources.tables import StarSchema
from shoptrail.streaming import sinks as stream_sinks

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
BATCH = sorted(k for k in QUERIES if not k.startswith("stream_"))


def physical_plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def event_scans(plan):
    return [block for block in plan.split("\n\n") if "Scan parquet" in block and "events.parquet" in block]


@pytest.mark.parametrize("key", BATCH)
def test_no_cross_join_and_no_python(spark, key):
    plan = physical_plan(QUERIES[key](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Scan ExistingRDD"):
        assert operator not in plan


UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture
def seen(monkeypatch):
    """Plans of the tables that a query stores before it returns, and of a stream's micro-batches."""
    plans = []

    def keep(df, purpose, real=runtime.stored):
        plans.append(physical_plan(df))
        return real(df, purpose)

    def keep_partitions(table, df, *rest, real=stream_sinks.CurrentRows._write):
        plans.append(physical_plan(df))
        real(table, df, *rest)

    for module in (registry, ads, distributions, layouts, pageflow, sampling):
        monkeypatch.setattr(module, "stored", keep)
    monkeypatch.setattr(stream_sinks.CurrentRows, "_write", keep_partitions)
    return plans


@pytest.mark.parametrize("key", ["category_top10_sessions", "page_flow_conversion", "session_random_extract", "ad_blacklist_replay",
                                 "stream_ad_province_city_counts", "stream_ad_live_province_top3"])
def test_stored_parts_and_batches_have_good_plans(spark, seen, key):
    QUERIES[key](spark, FOLDER).collect()
    assert len(seen) >= (STAGED_PARTS if key.startswith("stream_") else 1)
    for plan in seen:
        assert not [operator for operator in UNWANTED if operator in plan]
    if key.startswith(("category", "session")):
        scans = [s for plan in seen for s in event_scans(plan)]
        assert scans and all("GreaterThanOrEqual(ts" in s and "LessThan(ts" in s for s in scans)


@pytest.mark.parametrize("key", ["session_hour_counts", "session_random_extract"])
def test_no_window_without_keys(spark, seen, key):
    for plan in [physical_plan(QUERIES[key](spark, FOLDER)), *seen]:
        assert "Exchange SinglePartition" not in plan or "Window" not in plan.split("Exchange SinglePartition")[0]


# Page queries and those on laid-out tables or sketches scan the events in a stored part.
STORED_FIRST = ("ad_", "page_", "visits_", "session_length_quantiles", "distinct_by_period")


@pytest.mark.parametrize("key", [k for k in BATCH if not k.startswith(STORED_FIRST)])
def test_period_reaches_the_scan(spark, key):
    scans = event_scans(physical_plan(QUERIES[key](spark, FOLDER)))
    assert scans and all("GreaterThanOrEqual(ts" in s and "LessThan(ts" in s for s in scans)


def test_lengths_read_two_columns(spark):
    plan = physical_plan(registry.session_ratio_stats(spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_user_conditions_act_below_the_join(spark):
    star = StarSchema(spark, FOLDER)
    params = TaskParams("2024-01-01", "2024-01-30", cities=("NATION_3",), sex="male")
    kept = sessions.matching(star.actions(params), star.users(), params)
    assert "EqualTo(n_name,NATION_3)" in physical_plan(kept)


def test_clicks_are_selected_in_the_scan(spark):
    plan = physical_plan(registry.area_product_clicks(spark, FOLDER))
    assert "EqualTo(event_type,click)" in plan


def test_users_are_joined_by_shuffle_when_they_do_not_fit(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical_plan(registry.session_user_profile(spark, FOLDER))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert registry.session_user_profile(spark, FOLDER).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
