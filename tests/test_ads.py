import collections
import random

import pytest
from pyspark.sql import Observation

from shoptrail.operators import ads

DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def line(ms, user=1, ad=1, province="p", city="c"):
    return f"{START + ms} {province} {city} {user} {ad}"


def lines_frame(spark, lines):
    return spark.createDataFrame([(text,) for text in lines], "value string")


def clicks_frame(spark, lines):
    return ads.parse(lines_frame(spark, lines))


def test_parse_types_fields(spark):
    row = clicks_frame(spark, [line(DAY - 1, user=5, ad=3, province="north", city="x")]).first()
    assert (row.ts_ms, row.date, row.province, row.city, row.user_id, row.adid) == (
        START + DAY - 1,
        "2024-01-01",
        "north",
        "x",
        5,
        3,
    )


def test_malformed_lines_drop_out_and_are_counted(spark):
    good = line(0)
    broken = ["", "1 2 3", "x p c 1 1", f"{START} p c u 1", f"{START} p c 1 a", f"{START}  c 1 1", "99999999999999999 p c 1 1", None]
    observation = Observation()
    rows = ads.parse(lines_frame(spark, [good, *broken, good + " more"]), observation).select("line").collect()
    assert [r.line for r in rows] == [good, "99999999999999999 p c 1 1", good + " more"]
    assert observation.get == {"lines": 10, "malformed": 7}


def test_times_beyond_timestamps_keep_their_number(spark):
    clicks = clicks_frame(spark, ["99999999999999999 p c 1 1", "-62135596800001 p c 1 1", "253402300800000 p c 1 1"])
    found = {r.ts_ms: r.undated for r in clicks.selectExpr("ts_ms", "date is null as undated").collect()}
    assert found == {99999999999999999: True, -62135596800001: False, 253402300800000: False}


def test_blacklist_counts_per_day_and_ad(spark):
    lines = [line(i, user=1, ad=1) for i in range(3)]
    lines += [line(i, user=2, ad=1) for i in range(2)] + [line(DAY, user=2, ad=1)]
    lines += [line(i, user=3, ad=i) for i in range(5)]
    counts = ads.user_ad_counts(clicks_frame(spark, lines))
    assert [r.user_id for r in ads.blacklist(counts, 2).collect()] == [1]
    kept = ads.without_listed(clicks_frame(spark, lines), ads.blacklist(counts, 2))
    assert sorted({r.user_id for r in kept.collect()}) == [2, 3]


def replay_by_hand(lines, threshold):
    counts, listed, kept = collections.Counter(), set(), []
    for text in sorted(lines, key=lambda t: (int(t.split()[0]), t)):
        ms, _, _, user, ad = text.split()
        if user in listed:
            continue
        kept.append(text)
        key = ((int(ms) - START) // DAY, user, ad)
        counts[key] += 1
        if counts[key] > threshold:
            listed.add(user)
    return sorted(kept)


@pytest.mark.parametrize("seed", range(5))
def test_replay_matches_event_at_a_time_processing(spark, seed):
    rng = random.Random(seed)
    lines = [
        line(rng.randrange(6) + DAY * rng.randrange(2), user=rng.choice([1, 1, 1, 2, 3]), ad=rng.randrange(3))
        for _ in range(120)
    ]
    lines += [line(3, user=1, ad=1)] * rng.randrange(8)
    lines += [line(rng.randrange(5) * 60_000 + rng.randrange(3), user=rng.choice([4, 5]), ad=rng.randrange(2)) for _ in range(40)]
    found = sorted(r.line for r in ads.replay(clicks_frame(spark, lines), 4).collect())
    assert found == replay_by_hand(lines, 4)


def test_replay_keeps_at_least_what_the_up_front_list_keeps(spark):
    rng = random.Random(9)
    lines = [line(i, user=rng.randrange(5), ad=rng.randrange(2)) for i in range(60)]
    clicks = clicks_frame(spark, lines)
    listed = ads.blacklist(ads.user_ad_counts(clicks), 5)
    up_front = {r.line for r in ads.without_listed(clicks, listed).collect()}
    assert up_front <= {r.line for r in ads.replay(clicks, 5).collect()}


def test_province_top_breaks_ties_by_ad(spark):
    rows = [("d", "p", c, ad, n) for c, ad, n in [("a", 4, 2), ("b", 4, 1), ("a", 3, 3), ("a", 2, 3), ("a", 1, 1)]]
    counts = spark.createDataFrame(rows, "date string, province string, city string, adid bigint, click_count bigint")
    top = sorted(ads.province_top(counts, 3).collect(), key=lambda r: r["rank"])
    assert [(r.adid, r.click_count) for r in top] == [(2, 3), (3, 3), (4, 3)]


def test_minute_counts(spark):
    lines = [line(61_000, ad=2), line(119_999, ad=2), line(120_000, ad=2), line(DAY + 13 * 3_600_000, ad=1)]
    found = {tuple(r) for r in ads.minute_counts(clicks_frame(spark, lines)).collect()}
    assert found == {
        ("20240101", "00", "01", 2, 2),
        ("20240101", "00", "02", 2, 1),
        ("20240102", "13", "00", 1, 1),
    }


@pytest.mark.parametrize("minutes", [1, 5, 60])
def test_sliding_counts_match_brute_force(spark, minutes):
    rng = random.Random(minutes)
    clicks = [(rng.randrange(200 * 60_000), rng.randrange(2)) for _ in range(50)]
    expected = collections.Counter()
    for ms, ad in clicks:
        for back in range(minutes):
            expected[(ms // 60_000 - back, ad)] += 1
    found = ads.sliding_counts(clicks_frame(spark, [line(ms, ad=ad) for ms, ad in clicks]), minutes)
    rows = found.selectExpr("unix_millis(window_start) as ms", "adid", "click_count").collect()
    assert {((r.ms - START) // 60_000, r.adid): r.click_count for r in rows} == expected
    assert len(rows) == len(expected)
