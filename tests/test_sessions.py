import datetime as dt

import pytest
from pyspark.sql import Observation

from shoptrail.operators import sampling, sessions
from shoptrail.params import TaskParams

PARAMS = TaskParams("2024-01-01", "2024-01-31")
ACTIONS = (
    "event_id bigint, date string, user_id bigint, session_id string, page_id bigint, action_time timestamp, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, order_category_ids string, "
    "pay_category_ids string, city_id bigint"
)


def action(event_id, session, second=0, user=1, page=1, keyword=None, category=-1, order=None, pay=None):
    at = dt.datetime(2024, 1, 1, 5) + dt.timedelta(seconds=second)
    return (event_id, "2024-01-01", user, session, page, at, keyword, category, -1, order, pay, 0)


@pytest.fixture(scope="module")
def users(spark):
    rows = [(1, 30, "p1", "male", "c1"), (2, 40, "p2", "female", "c2")]
    return spark.createDataFrame(rows, "user_id bigint, age int, professional string, sex string, city string")


def frame(spark, rows):
    return spark.createDataFrame(rows, ACTIONS)


def test_roll_up_of_one_session(spark):
    rows = [
        action(1, "s", 10, user=7, keyword="tea"),
        action(2, "s", 0, user=3, keyword="green tea"),
        action(3, "s", 75, user=3, keyword="tea", category=11),
        action(4, "s", 30, user=3, keyword="", category=1),
        action(5, "s", 30, user=3, category=11),
    ]
    row = sessions.roll_up(frame(spark, rows)).first()
    assert (row.user_id, row.visit_length, row.step_length) == (3, 75, 5)
    assert row.search_keywords == "green tea,tea"
    assert row.click_category_ids == "1,11"
    assert row.start_time == dt.datetime(2024, 1, 1, 5)


def test_session_without_searches_or_clicks_has_nulls(spark):
    row = sessions.roll_up(frame(spark, [action(1, "s")])).first()
    assert row.search_keywords is None and row.click_category_ids is None
    assert (row.visit_length, row.step_length) == (0, 1)


def test_keyword_and_category_conditions(spark, users):
    rows = [
        action(1, "a", keyword="tea"),
        action(2, "b", keyword="green tea", category=3),
        action(3, "b", keyword="tea"),
        action(4, "c", category=33),
        action(5, "d"),
    ]
    actions = frame(spark, rows)

    def kept(**changes):
        found = sessions.matching(actions, users, PARAMS.replace(**changes))
        assert "keyword_hit" not in found.columns and "category_hit" not in found.columns
        return sorted(r.session_id for r in found.collect())

    assert kept() == ["a", "b", "c", "d"]
    assert kept(keywords=("tea",)) == ["a", "b"]
    assert kept(keywords=("green tea", "coffee")) == ["b"]
    assert kept(category_ids=(3,)) == ["b"]
    assert kept(category_ids=(33, 3)) == ["b", "c"]
    assert kept(keywords=("tea",), category_ids=(33,)) == []
    assert kept(category_ids=(-1,)) == []


def test_sessions_of_unknown_users_drop_out(spark, users):
    actions = frame(spark, [action(1, "known", user=2), action(2, "unknown", user=99)])
    kept = sessions.matching(actions, users, PARAMS)
    assert [r.session_id for r in kept.collect()] == ["known"]
    assert [r.event_id for r in sessions.actions_of(actions, kept).collect()] == [1]


def lengths(spark, visits=(), steps=()):
    rows = [(v, 0) for v in visits] + [(0, s) for s in steps]
    return spark.createDataFrame(rows, "visit_length bigint, step_length bigint")


def test_visit_bands_at_their_edges(spark):
    edges = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    counts = {r.band: r.sessions for r in sessions.visit_length_bands(lengths(spark, visits=edges)).collect()}
    assert counts.pop("30m") == 1
    assert set(counts.values()) == {2} and len(counts) == 8


def test_step_bands_at_their_edges(spark):
    edges = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    counts = {r.band: r.sessions for r in sessions.step_length_bands(lengths(spark, steps=edges)).collect()}
    assert counts.pop("60") == 1
    assert set(counts.values()) == {2} and len(counts) == 5


def test_ratios_without_sessions_are_zero(spark):
    row = sessions.ratio_stats(lengths(spark, visits=[1]).where("false")).first().asDict()
    assert row.pop("session_count") == 0
    assert len(row) == 15 and set(row.values()) == {0.0}


def test_ratio_rounds_half_up(spark):
    row = sessions.ratio_stats(lengths(spark, visits=[1] + [0] * 7)).first()
    assert (row.session_count, row.visit_length_1s_3s_ratio) == (8, 0.13)


def test_counters_can_be_observed(spark):
    observation = Observation()
    sessions.observed(lengths(spark, visits=[2, 2, 1900]), observation).write.format("noop").mode("overwrite").save()
    assert observation.get["session_count"] == 3
    assert observation.get["visit_length_1s_3s"] == 2 and observation.get["visit_length_30m"] == 1


def spread(spark, hours):
    """``hours``: {(day, hour): sessions}."""
    rows = [
        (f"s{d}-{h}-{i}", dt.datetime(2024, 1, d, h, i % 60), "kw", "1")
        for (d, h), n in hours.items()
        for i in range(n)
    ]
    schema = "session_id string, start_time timestamp, search_keywords string, click_category_ids string"
    return spark.createDataFrame(rows, schema)


def brute_force_quota(hours, size):
    days = {d for d, _ in hours}
    per_day = size // len(days)
    total = {d: sum(n for (day, _), n in hours.items() if day == d) for d in days}
    quota = {key: min(n, int(n / total[key[0]] * per_day)) for key, n in hours.items()}
    return {k: v for k, v in quota.items() if v}


@pytest.mark.parametrize("size", [1, 3, 10, 40, 1500, 1_000_000])
def test_sample_follows_quota(spark, size):
    hours = {(1, 5): 60, (1, 6): 20, (1, 7): 1, (2, 0): 7, (2, 23): 33, (3, 12): 4}
    df = spread(spark, hours)
    drawn = sampling.extract(sampling.draw(df, size, seed=1), df).collect()
    assert len({r.session_id for r in drawn}) == len(drawn)
    found = {}
    for r in drawn:
        key = (int(r.date[-2:]), int(r.hour))
        found[key] = found.get(key, 0) + 1
    assert found == brute_force_quota(hours, size)


def test_sample_is_reproducible_whatever_the_partitioning(spark):
    hours = {(1, 5): 50, (1, 6): 30}

    def draw(seed, parts):
        df = spread(spark, hours).repartition(parts)
        return sorted(r.session_id for r in sampling.draw(df, 20, seed).collect())

    assert draw(1, 2) == draw(1, 7)
    assert draw(1, 2) != draw(2, 2)


def test_hour_counts(spark):
    counted = sampling.with_day_count(sampling.hour_counts(spread(spark, {(1, 5): 3, (1, 6): 1, (2, 5): 2})))
    rows = sorted(tuple(r) for r in counted.select("date", "hour", "sessions", "day_sessions", "days").collect())
    assert rows == [("2024-01-01", "05", 3, 4, 2), ("2024-01-01", "06", 1, 4, 2), ("2024-01-02", "05", 2, 2, 2)]


def test_histogram_plan_reads_no_sets(spark, users):
    """The keyword and category sets are pruned where only lengths are read."""
    actions = frame(spark, [action(1, "a")])
    plan = sessions.ratio_stats(sessions.matching(actions, users, PARAMS))._jdf.queryExecution().optimizedPlan()
    assert "collect_set" not in plan.toString()
