"""Every registered query against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from shoptrail.plans import registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "part", "events"]
QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_entry_point_has_every_query():
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, FOLDER)
    result = duck.execute(SQL[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = _sorted_rows(result.fetchall(), names)
    found = _sorted_rows([tuple(r) for r in df.collect()], df.columns)
    assert len(found) == len(expected)
    assert found == expected
    assert expected, "an empty result checks nothing"


def test_period_leaves_days_out_on_either_side(spark):
    """A wrong or missing bound must show: both edge days have rows, and so have the days before and after."""
    dates = {r["date"] for r in QUERIES["actions_by_date"](spark, FOLDER).select("date").distinct().collect()}
    assert (min(dates), max(dates)) == (registry.PARAMS.start_date, registry.PARAMS.end_date)
    all_days = spark.read.parquet(f"{FOLDER}/events.parquet").selectExpr("min(date(ts)) as a", "max(date(ts)) as b").first()
    assert str(all_days["a"]) < min(dates) and max(dates) < str(all_days["b"])


def test_session_time_zone_is_left_as_it_was(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = {tuple(r) for r in QUERIES["session_hour_counts"](spark, FOLDER).collect()}
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {tuple(r) for r in QUERIES["session_hour_counts"](spark, FOLDER).collect()}
