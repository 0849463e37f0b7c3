import random

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.ranking import top_per_group


@pytest.mark.parametrize("n", [4, 2000])
def test_top_per_group_is_exact_for_any_n(spark, n):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", rng.randrange(1000), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(6)
    found = top_per_group(df, ["k"], [F.desc("v"), F.asc("id")], n).collect()
    expected = set()
    for k in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))[:n]
        expected |= {(*r, i + 1) for i, r in enumerate(ordered)}
    assert {tuple(r) for r in found} == expected


def test_groups_are_cut_before_the_shuffle_and_in_shards(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = top_per_group(df, ["k"], [F.desc("v")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and plan.count("Exchange hashpartitioning") == 2
