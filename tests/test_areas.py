import pytest
from pyspark.sql import functions as F

from shoptrail.operators import areas
from shoptrail.sources.tables import AREA_LEVELS, city_areas

LEVELS = {"north": "A_Level", "south": "B_Level"}


@pytest.fixture(scope="module")
def clicks(spark):
    rows = [(1, 7)] * 3 + [(11, 7)] * 2 + [(2, 8)] + [(1, 9)] + [(1, -1)] * 5 + [(99, 7)]
    return spark.createDataFrame(rows, "city_id bigint, click_product_id bigint")


@pytest.fixture(scope="module")
def cities(spark):
    rows = [(1, "X", "north"), (11, "X", "north"), (2, "Y", "east")]
    return spark.createDataFrame(rows, "city_id bigint, city_name string, area string")


def test_clicks_per_area_keep_cities_that_contain_each_other(clicks, cities):
    found = {tuple(r) for r in areas.product_clicks(clicks, cities).collect()}
    assert found == {("north", 7, 5, "11:X,1:X"), ("north", 9, 1, "1:X"), ("east", 8, 1, "2:Y")}


def test_products_and_owner(spark, clicks, cities):
    products = spark.createDataFrame(
        [(7, "seven", '{"product_status": 0}'), (8, "eight", '{"product_status": 1}'), (5, "five", "{}")],
        "product_id bigint, product_name string, extend_info string",
    )
    enriched = areas.with_products(areas.product_clicks(clicks, cities), products)
    found = {(r.area, r.product_id, r.product_name, r.product_status) for r in enriched.collect()}
    assert found == {("north", 7, "seven", "Self"), ("east", 8, "eight", "Third Party")}


def test_top_products_break_ties_by_id(spark):
    rows = [("north", p, c, "") for p, c in [(5, 1), (4, 2), (3, 2), (2, 2), (1, 1)]] + [("east", 9, 1, "")]
    df = spark.createDataFrame(rows, "area string, product_id bigint, click_count bigint, city_infos string")
    top = areas.top_products(df, LEVELS, 3).orderBy("area", "rank").collect()
    assert [(r.area, r.product_id, r.area_level) for r in top] == [
        ("east", 9, None),
        ("north", 2, "A_Level"),
        ("north", 3, "A_Level"),
        ("north", 4, "A_Level"),
    ]


def test_built_in_city_table(spark):
    leveled = city_areas(spark).withColumn("level", areas.area_level(F.col("area"), AREA_LEVELS))
    rows = leveled.collect()
    assert len(rows) == 10 and len({r.area for r in rows}) == 7
    assert {r.level for r in rows} == {"A_Level", "B_Level", "C_Level", "D_Level"}
    assert next(r.level for r in rows if r.city_id == 5) == "B_Level"
