import collections
import random

import pytest
from test_sessions import action, frame

from shoptrail.operators import pageflow


def brute_force(rows):
    by_session = collections.defaultdict(list)
    for r in rows:
        by_session[r[3]].append((r[5], r[0], r[4]))
    counts = collections.Counter()
    for visits in by_session.values():
        pages = [page for _, _, page in sorted(visits)]
        counts.update(zip(pages, pages[1:]))
    return counts


def random_rows(n, seed):
    rng = random.Random(seed)
    return [
        action(i, "hot" if rng.random() < 0.5 else f"s{rng.randrange(12)}", rng.randrange(20), page=rng.randrange(4))
        for i in range(n)
    ]


@pytest.fixture(params=[1, 4, 60])
def partitions(spark, request):
    """Into how many slices the visits are cut; 60 cut every session of the small tables."""
    keys = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("tie_break", ["event_id", None])
def test_transitions_match_brute_force_whichever_sessions_are_cut(spark, partitions, tie_break):
    rows = random_rows(400, seed=3)
    if tie_break is None:  # the order inside a second is open: leave one visit per second
        rows = list({(r[3], r[5]): r for r in rows}.values())
    steps = pageflow.page_steps(frame(spark, rows), tie_break)
    found = {(r.from_page, r.to_page): r.transitions for r in pageflow.transitions(steps).collect()}
    assert found == brute_force(rows)
    assert steps.selectExpr("sum(views)").first()[0] == len(rows)


def test_no_slice_holds_a_whole_hot_session(spark):
    """1,500 sessions of 400 actions and one of two million actions in one second, in 64 slices."""
    hot = spark.range(0, 2_000_000, 1, 8).selectExpr("'hot' as session_id", "0L as at", "id as event_id")
    others = spark.range(0, 600_000, 1, 8).selectExpr("concat('s', id % 1500) as session_id", "id div 1500 as at", "id + 2000000 as event_id")
    actions = hot.union(others).selectExpr("session_id", "event_id % 7 as page_id", "timestamp_seconds(1704067200 + at) as action_time", "event_id")
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        cut = pageflow.slices(actions)
        sizes = cut.groupBy("session_id", "slice").count()
        assert sizes.agg({"count": "max"}).first()[0] < 200_000
        steps = pageflow.page_steps(actions)
        found = {(r.from_page, r.to_page): r.transitions for r in pageflow.transitions(steps).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(found.values()) == 2_000_000 - 1 + 600_000 - 1500
    assert sum(n for (a, b), n in found.items() if b == (a + 1) % 7) >= 2_000_000 - 1


def test_no_page_is_preferred_within_a_second(spark):
    rows = [action(2 * i + k, f"s{i}", 0, page=p) for i in range(400) for k, p in enumerate((2, 1))]
    found = {(r.from_page, r.to_page): r.transitions for r in pageflow.transitions(pageflow.page_steps(frame(spark, rows), None)).collect()}
    assert set(found) == {(1, 2), (2, 1)} and min(found.values()) > 120


def test_conversion_along_flow(spark, partitions):
    pages = [1, 2, 3, 1, 2, 9, 1]
    rows = [action(i, "s", i, page=p) for i, p in enumerate(pages)]
    steps = pageflow.page_steps(frame(spark, rows))
    converted = pageflow.conversion(steps, (1, 2, 3, 4, 5))
    assert [tuple(r) for r in converted.orderBy("step").collect()] == [
        (1, "1_2", 2, 3, 2 / 3),
        (2, "2_3", 1, 2, 0.5),
        (3, "3_4", 0, 1, 0.0),
        (4, "4_5", 0, 0, None),
    ]
    assert pageflow.conversion_text(converted, digits=3).first()[0] == "1_2=0.667|2_3=0.500|3_4=0.000|4_5="
    assert pageflow.conversion_text(converted).first()[0] == f"1_2={2 / 3}|2_3=0.5|3_4=0.0|4_5="


def test_start_page_without_views(spark):
    steps = pageflow.page_steps(frame(spark, [action(1, "s", 0, page=5), action(2, "s", 1, page=6)]))
    assert [tuple(r) for r in pageflow.conversion(steps, (1, 2)).collect()] == [(1, "1_2", 0, 0, None)]


def test_flow_that_repeats_a_pair(spark):
    rows = [action(i, "s", i, page=p) for i, p in enumerate([1, 2, 1, 2])]
    converted = pageflow.conversion(pageflow.page_steps(frame(spark, rows)), (1, 2, 1, 2))
    assert [(r.pair, r.transitions) for r in converted.orderBy("step").collect()] == [("1_2", 2), ("2_1", 1), ("1_2", 2)]


def test_flow_needs_two_pages(spark):
    with pytest.raises(ValueError):
        pageflow.conversion(pageflow.page_steps(frame(spark, [])), (1,))


def test_same_second_is_ordered_by_tie_break(spark):
    rows = [action(3, "s", 0, page=30), action(1, "s", 0, page=10), action(2, "s", 0, page=20)]
    found = {(r.from_page, r.to_page) for r in pageflow.transitions(pageflow.page_steps(frame(spark, rows))).collect()}
    assert found == {(10, 20), (20, 30)}
