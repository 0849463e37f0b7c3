import pytest
from test_sessions import action, frame

from shoptrail.params import TaskParams
from shoptrail.plans import reports
from shoptrail.sources import sinks, tables

PARAMS = TaskParams("2024-01-01", "2024-01-31", page_flow=(1, 2), task_id="t")


class Collector:
    def __init__(self):
        self.tables = {}

    def __call__(self, df, name):
        self.tables[name] = (df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def actions(spark):
    rows = [
        action(1, "a", 0, page=1, keyword="tea"),
        action(2, "a", 2, page=2, category=5),
        action(3, "a", 9, page=1, order="5,6"),
        action(4, "b", 0, user=2, page=1, pay="6"),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def users(spark):
    rows = [(1, "u", "n", 30, "p", "c", "male"), (2, "u", "n", 40, "p", "c", "male")]
    return spark.createDataFrame(
        rows, "user_id bigint, username string, name string, age int, professional string, city string, sex string"
    )


def test_session_job(actions, users):
    out = Collector()
    counters = reports.run_session_job(actions, users, PARAMS, out)
    assert counters["session_count"] == 2 and counters["visit_length_7s_9s"] == 1
    columns, (row,) = out.tables["session_stat_ratio"]
    stats = dict(zip(columns, row))
    assert len(columns) == 17 and stats["taskid"] == "t" and stats["session_count"] == 2
    assert stats["visit_length_7s_9s_ratio"] == 0.5 and stats["step_length_1_3_ratio"] == 1.0
    columns, drawn = out.tables["session_extract"]
    assert columns == ["taskid", "sessionid", "startTime", "searchKeywords", "clickCategoryIds"]
    assert sorted(drawn, key=str) == [("t", "a", "2024-01-01 05:00:00", "tea", "5"), ("t", "b", "2024-01-01 05:00:00", None, None)]
    assert out.tables["top_categories"] == (
        ["taskid", "categoryid", "clickCount", "orderCount", "payCount"],
        [("t", 5, 1, 1, 0), ("t", 6, 0, 1, 1)],
    )
    assert out.tables["top_sessions_per_category"][1] == [("t", 5, "a", 1)]


def test_page_flow_job(actions):
    out = Collector()
    reports.run_page_flow_job(actions, PARAMS, out)
    assert out.tables["page_skip_ratio"] == (["taskid", "convertRate"], [("t", f"1_2={1 / 3}")])


def test_area_job(spark):
    out = Collector()
    clicks = spark.createDataFrame([("2024-01-01", 0, 7), ("2025-01-01", 0, 8)], "date string, city_id bigint, click_product_id bigint")
    products = spark.createDataFrame([(7, "seven", '{"product_status": 0}')], "product_id bigint, product_name string, extend_info string")
    reports.run_area_job(clicks, tables.city_areas(spark), products, tables.AREA_LEVELS, PARAMS, out)
    assert out.tables["area_top_products"] == (
        ["taskid", "area", "areaLevel", "productid", "cityInfos", "clickCount", "productName", "productStatus"],
        [("t", "华北", "A_Level", 7, "0:北京", 1, "seven", "Self")],
    )


def test_catalog_tables(spark):
    times = ["2024-01-01 5:03:02", "no time", None]
    raw = spark.createDataFrame([("2024-01-01", t) for t in times], "date string, action_time string")
    tables.save_table(raw, "visits", partition_by=("date",))
    tables.save_table(raw.union(raw), "visits")
    read = tables.visit_actions(spark, "visits")
    assert dict(read.dtypes)["action_time"] == "timestamp"
    assert [str(r.action_time) for r in read.collect()] == ["2024-01-01 05:03:02"] * 2
    spark.sql("DROP TABLE visits")


def test_parquet_sink_appends(spark, tmp_path):
    folder = str(tmp_path / "report")
    for _ in range(2):
        sinks.append_parquet(spark.range(3).toDF("n"), folder)
    assert spark.read.parquet(folder).count() == 6


def test_jdbc_sink_appends_with_bounded_connections():
    """Only the hand-over to Spark's JDBC writer; no database is started."""
    calls = {}

    class Writer:
        def option(self, key, value):
            calls[key] = value
            return self

        def jdbc(self, url, table, mode, properties):
            calls.update(url=url, table=table, mode=mode, properties=properties)

    class Frame:
        write = Writer()

    sinks.append_jdbc(Frame(), "jdbc:x", "t", {"user": "u"}, connections=3)
    assert calls == {"numPartitions": 3, "url": "jdbc:x", "table": "t", "mode": "append", "properties": {"user": "u"}}
