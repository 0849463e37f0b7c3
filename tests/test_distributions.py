"""Sketches per day against exact answers."""

import random

import pytest
from pyspark.sql import functions as F

from shoptrail.operators import distributions as D
from shoptrail.operators.sessions import VISIT_BANDS

PERIODS = (("first", "2024-01-01", "2024-01-03"), ("second", "2024-01-03", "2024-01-09"), ("none", "2025-01-01", "2025-01-02"))
PERMILLES = (0, 1, 250, 500, 777, 999, 1000)


@pytest.fixture(scope="module")
def values():
    """Lengths per day: one day holds a third of all, most lengths repeat, a few are far out."""
    rng = random.Random(5)
    days = {f"2024-01-0{d}": [int(rng.paretovariate(0.7)) for _ in range(2_000)] for d in range(1, 8)}
    days["2024-01-03"] = [min(int(rng.expovariate(0.01)), 700) for _ in range(6_000)] + [10**12, 0, 0]
    return days


@pytest.fixture(scope="module")
def lengths(spark, values):
    rows = [(day, "visit_length", v) for day, of_day in values.items() for v in of_day]
    rows += [("2024-01-02", "step_length", 5)]
    return spark.createDataFrame(rows, "date string, measure string, length bigint").repartition(7)


def exact(values, period, permille):
    _, first, last = period
    ordered = sorted(v for day, of_day in values.items() if first <= day <= last for v in of_day)
    return ordered[max(-(-len(ordered) * permille // 1000), 1) - 1]


# The sketches of size 8 are far off, and an error of nearly zero trusts them: the counts must show it.
@pytest.mark.parametrize("size, error", [(D.KLL_SIZE, D.RANK_ERROR), (200, 0.02), (8, 1e-6), (8, 2.0)])
def test_quantiles_are_exact_however_good_the_sketch(lengths, values, size, error):
    merged = D.merged(D.length_sketches(lengths, size), PERIODS, size)
    found = {(r["period"], r["measure"], r["permille"]): r["length"] for r in D.quantiles(lengths, merged, PERMILLES, error).collect()}
    expected = {(p[0], "visit_length", m): exact(values, p, m) for p in PERIODS[:2] for m in PERMILLES}
    expected |= {("first", "step_length", m): 5 for m in PERMILLES}
    assert found == expected


def test_bands_are_estimated_within_the_bound(lengths, values):
    merged = D.merged(D.length_sketches(lengths), PERIODS)
    estimates = {(r["period"], r["band"]): (r["estimate"], r["n"]) for r in D.band_estimates(merged, "visit_length", VISIT_BANDS).collect()}
    assert len(estimates) == 2 * len(VISIT_BANDS)
    for name, first, last in PERIODS[:2]:
        kept = [v for day, of_day in values.items() if first <= day <= last for v in of_day]
        for band, low, high in VISIT_BANDS:
            estimate, n = estimates[name, band]
            assert n == len(kept)
            assert abs(estimate - sum(low <= v and (high is None or v <= high) for v in kept)) <= 2 * D.RANK_ERROR * n


def test_no_lengths_give_no_quantiles(lengths):
    none = lengths.where("false")
    assert D.quantiles(none, D.merged(D.length_sketches(none), PERIODS), PERMILLES).collect() == []


def visits(spark, users):
    """Two overlapping sets of users, each on many days; repeated rows; a column of nulls."""
    days = F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string"))
    early = spark.range(0, users).select(days.alias("date"), F.col("id").alias("user_id"))
    late = spark.range(users // 2, users * 2).select(F.lit("2024-01-08").alias("date"), F.col("id").alias("user_id"))
    return early.unionByName(early).unionByName(late).withColumn("nothing", F.lit(None).cast("bigint"))


def counts(spark, users, **more):
    names = ["user_id", "nothing"]
    found = D.distinct_counts(D.distinct_sketches(visits(spark, users), names, **more), names, PERIODS[0], PERIODS[1], **more)
    return {r["counted"]: tuple(r)[1:] for r in found.collect()}


def test_distinct_counts_are_exact_while_they_fit(spark):
    # The third day lies in both sets of days.
    seen = visits(spark, 9_000).collect()
    a, b = ({r["user_id"] for r in seen if first <= r["date"] <= last} for _, first, last in PERIODS[:2])
    found = counts(spark, 9_000)
    assert found["user_id"] == (len(a), len(b), len(a | b), len(a - b), len(b - a))
    assert found["nothing"] == (0, 0, 0, 0, 0)


def test_distinct_counts_are_estimates_beyond(spark):
    early, late, union, gone, added = counts(spark, 300_000, log=12)["user_id"]
    # The late set holds users 150,000 to 599,999 and every third one of the rest, by its third day.
    for found, expected in ((early, 300_000), (late, 500_000), (union, 600_000), (gone, 100_000), (added, 300_000)):
        assert abs(found - expected) <= 5 * 600_000 / 2**6 / 2**0.5 * (expected / 600_000) ** 0.5


def test_sketches_are_small_whatever_they_count(spark):
    sizes = D.distinct_sketches(visits(spark, 200_000), ["user_id"], 10).select(F.max(F.length("user_id"))).first()[0]
    assert sizes <= 2**10 * 8 * 2
