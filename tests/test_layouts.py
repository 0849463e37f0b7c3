"""Tables by day and by bucket: which files are read, which joins need no shuffle."""

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.sessions import PROFILE_COLUMNS
from shoptrail.plans import registry
from shoptrail.sources import layouts
from shoptrail.sources.tables import StarSchema

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joined(left, right):
    return left.join(right, ["user_id", "part"])


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def visits(spark):
    """A third of the visits are user 7's; some have no user, some an unknown one."""
    user = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
    return spark.range(0, 30_000, 1, 4).select(
        F.col("id").alias("event_id"),
        user.alias("user_id"),
        F.when(F.col("id") % 2 == 0, 3).otherwise(-1).alias("click_category_id"),
        F.when(F.col("id") % 5 == 0, "4").alias("pay_category_ids"),
    )


@pytest.fixture
def users(spark):
    key = F.col("id")
    return spark.range(0, 300).select(
        key.alias("user_id"),
        key.cast("int").alias("age"),
        F.concat(F.lit("p"), key % 4).alias("professional"),
        F.concat(F.lit("c"), key % 3).alias("city"),
        F.lit("female").alias("sex"),
    )


def scans(node):
    """File scans of an executed plan, also below the stages that adaptive execution made."""
    inner = {"AdaptiveSparkPlan": "executedPlan", "QueryStage": "plan", "ReusedExchange": "child"}
    for name, way in inner.items():
        if name in node.nodeName() or name in node.getClass().getSimpleName():
            return scans(getattr(node, way)())
    children = [node.children().apply(i) for i in range(node.children().size())]
    return [s for child in children for s in scans(child)] if children else [node]


def test_days_prune_folders_at_run_time(spark):
    visits = layouts.saved_by_date(StarSchema(spark, FOLDER).actions(registry.PARAMS).select("event_id", "date", "page_id"))
    days = layouts.busy_days(visits)
    kept = layouts.of_days(visits, days)
    busy = {r["date"] for r in days.collect()}
    assert {r["date"] for r in kept.collect()} == busy
    assert "dynamicpruning" in plan_of(kept).lower()
    folders = {f.rsplit("/", 2)[1] for f in visits.inputFiles()}
    read = [s.metrics().apply("numPartitions").value() for s in scans(kept._jdf.queryExecution().executedPlan())
            if s.metrics().contains("numPartitions")]
    assert read == [len(busy)] and 0 < len(busy) < len(folders)


def test_a_busy_day_is_written_by_several_tasks(spark, no_broadcast):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 > 0, "2024-01-01").otherwise("2024-01-02").alias("date")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        saved = layouts.saved_by_date(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = [f for f in saved.inputFiles() if "date=2024-01-01" in f]
    assert len(files) > 1 and saved.count() == 200_000


def test_buckets_join_without_a_shuffle(spark, no_broadcast, visits, users):
    tables = layouts.co_located(visits, users, part_rows=500)
    plan = plan_of(joined(*tables))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("Bucketed: true") == 2


def test_visits_of_one_user_lie_in_many_parts(spark, visits, users):
    dealt, repeated = layouts.co_located(visits, users, part_rows=500)
    sizes = {(r["user_id"], r["part"]): r["count"] for r in dealt.groupBy("user_id", "part").count().collect()}
    of_seven = [n for (user, _), n in sizes.items() if user == 7]
    assert len(of_seven) == 21 and sum(of_seven) == visits.where("user_id = 7").count() and max(of_seven) < 700
    assert {part for (user, part) in sizes if user != 7} == {0}
    assert repeated.where("user_id = 7").count() == 21 and repeated.where("user_id <> 7").count() == 299
    assert dealt.count() == visits.count()


@pytest.mark.parametrize("part_rows", [1, 500, 10**9])
def test_counts_do_not_depend_on_the_parts(visits, users, part_rows):
    found = layouts.visits_by_profile(*layouts.co_located(visits, users, part_rows, bucket_rows=2_000))
    plain = layouts.visits_by_profile(visits.withColumn("part", F.lit(0)), users.withColumn("part", F.lit(0)))
    rows = sorted(map(tuple, plain.collect()))
    assert rows and sorted(map(tuple, found.collect())) == rows


def test_no_visits_give_no_rows(visits, users):
    assert layouts.visits_by_profile(*layouts.co_located(visits.where("false"), users)).collect() == []


def test_no_table_name_is_left_behind(spark, visits, users):
    before = {t.name for t in spark.catalog.listTables()}
    dealt, _ = layouts.co_located(visits.select("event_id", "user_id"), users.select("user_id", *PROFILE_COLUMNS))
    assert {t.name for t in spark.catalog.listTables()} == before and dealt.count() == 30_000
