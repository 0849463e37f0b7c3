"""Sketches per day that merge for any days: quantiles and bands of lengths (KLL), distinct counts (theta).

A sketch of a day has a bounded size, so the table of sketches grows with the days, not with the sessions. Periods are
``(name, first day, last day)`` and may overlap; a day without rows has no sketch and adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.runtime import stored

Period = tuple[str, str, str]

#: Size of the KLL sketches, and a bound on the error of a rank (as a share of all rows) that is some five times what the
#: sketch promises at this size.
KLL_SIZE, RANK_ERROR = 4096, 0.004
#: Theta sketches count exactly below two to this power, beyond it with a standard error of 0.4 %.
THETA_LOG = 16


def lengths(sessions: DataFrame) -> DataFrame:
    """Rows ``(date, measure, length)``: visit and step length of each session."""
    both = F.array(
        F.struct(F.lit("visit_length").alias("measure"), F.col("visit_length").cast("bigint").alias("length")),
        F.struct(F.lit("step_length").alias("measure"), F.col("step_length").cast("bigint").alias("length")),
    )
    return sessions.select(F.col("start_time").cast("date").cast("string").alias("date"), F.inline(both))


def length_sketches(lengths: DataFrame, size: int = KLL_SIZE) -> DataFrame:
    """One sketch per day and measure. Partial sketches merge, so a day of any size needs no task of its own."""
    return lengths.groupBy("date", "measure").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("length", F.lit(size)).alias("sketch")
    )


def _periods_of(date: Column, periods: Sequence[Period]) -> Column:
    """The periods that hold a day, as an array of structs."""
    known = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("period", "first", "last"), p)]) for p in periods])
    return F.filter(known, lambda p: date.between(p["first"], p["last"]))


def merged(sketches: DataFrame, periods: Sequence[Period], size: int = KLL_SIZE) -> DataFrame:
    """One sketch per period and measure from the sketches of its days."""
    in_periods = sketches.select("*", F.inline(_periods_of(F.col("date"), periods)))
    return in_periods.groupBy("period", "first", "last", "measure").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("sketch")
    )


def band_estimates(merged: DataFrame, measure: str, bands: Sequence[tuple[str, int, int | None]]) -> DataFrame:
    """Estimated sessions per band (any bands), from sketches alone; either edge is off by ``RANK_ERROR`` of all at most."""

    def upto(length: int) -> Column:
        return F.kll_sketch_get_rank_bigint("sketch", F.lit(length).cast("bigint"))

    def share(low: int, high: int | None) -> Column:
        return (F.lit(1.0) if high is None else upto(high)) - upto(low - 1)

    rows = F.array(
        *[F.struct(F.lit(name).alias("band"), (share(lo, hi) * F.col("n")).alias("estimate")) for name, lo, hi in bands]
    )
    return merged.where(F.col("measure") == measure).select("period", "measure", "n", F.inline(rows))


def _targets(merged: DataFrame, permilles: Sequence[int], error: float) -> DataFrame:
    """The ranks asked for, and the lengths between which the sketches put them; a null bound is open."""

    def at(share: float) -> Column:
        if 0 < share < 1:
            return F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(share)))
        return F.lit(None).cast("bigint")

    def target(permille: int) -> Column:
        rank = F.floor((F.col("n") * permille + 999) / 1000).cast("bigint")
        return F.struct(
            F.lit(permille).cast("bigint").alias("permille"),
            F.greatest(rank, F.lit(1).cast("bigint")).alias("target"),
            at(permille / 1000 - error).alias("low"),
            at(permille / 1000 + error).alias("high"),
        )

    return merged.select("period", "first", "last", "measure", "n", F.inline(F.array(*[target(p) for p in permilles])))


def _recount(lengths: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with the length at their rank, null where their bounds do not enclose it.

    Lengths below the lower bound are only counted, those above the upper one not even that; single values are told
    apart between the bounds. There is one target per period, measure and share asked for, so the list is broadcast.
    """
    inside = (
        (F.col("l.measure") == F.col("t.measure"))
        & F.col("l.date").between(F.col("t.first"), F.col("t.last"))
        & (F.col("t.high").isNull() | (F.col("l.length") <= F.col("t.high")))
    )
    value = F.when(F.col("low").isNull() | (F.col("length") >= F.col("low")), F.col("length")).alias("value")
    counts = (
        lengths.alias("l")
        .join(F.broadcast(targets.alias("t")), inside)
        .groupBy("period", "t.measure", "permille", "target", value)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    key = ["period", "measure", "permille"]
    upto = F.sum("rows").over(Window.partitionBy(*key).orderBy(F.asc_nulls_first("value")))
    reached = counts.withColumn("upto", upto).where(F.col("upto") >= F.col("target"))
    first = reached.groupBy(*key).agg(F.min_by("value", "upto").alias("length"))
    return targets.join(first, key, "left")


def quantiles(lengths: DataFrame, merged: DataFrame, permilles: Sequence[int], error: float = RANK_ERROR) -> DataFrame:
    """Exact quantiles without a sort: rows ``(period, measure, permille, n, length)``.

    ``length`` is the least one that ``permille`` thousandths of the period's sessions do not exceed. Sketches enclose it
    between two values, one pass over the lengths counts what lies below and between. Should a sketch be further off than
    ``error``, the counts show it, and the pass is repeated with bounds eight times as wide, up to open ones.
    """
    key = ["period", "measure", "permille"]
    found = left = None
    while True:
        targets = _targets(merged, permilles, error)
        targets = targets if left is None else targets.join(left.select(*key), key, "left_semi")
        counted = stored(_recount(lengths, targets), "quantiles")
        done = counted.where(F.col("length").isNotNull()).select(*key, "n", "length")
        found = done if found is None else found.unionByName(done)
        left = counted.where(F.col("length").isNull())
        if error >= 1 or left.isEmpty():
            return found
        error *= 8


def distinct_sketches(rows: DataFrame, names: Sequence[str], log: int = THETA_LOG) -> DataFrame:
    """One theta sketch per day and column of ``names``; nulls are not counted."""
    return rows.groupBy("date").agg(*[F.theta_sketch_agg(name, F.lit(log)).alias(name) for name in names])


def distinct_counts(
    sketches: DataFrame, names: Sequence[str], early: Period, late: Period, log: int = THETA_LOG
) -> DataFrame:
    """Distinct values of two sets of days and what changed: rows ``(counted, early, late, both_sets, gone, added)``.

    ``gone`` are those of the early days alone, ``added`` those of the late days alone. A day may lie in both.
    """

    def of(name: str, period: Period) -> Column:
        days = F.when(F.col("date").between(*period[1:]), F.col(name))
        return F.theta_union_agg(days, F.lit(log))

    unions = sketches.agg(*[of(name, p).alias(f"{name}_{k}") for name in names for k, p in (("a", early), ("b", late))])

    def count(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("bigint")

    def counts(name: str) -> Column:
        a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
        return F.struct(
            F.lit(name).alias("counted"),
            count(a).alias("early"),
            count(b).alias("late"),
            count(F.theta_union(a, b, F.lit(log))).alias("both_sets"),
            count(F.theta_difference(a, b)).alias("gone"),
            count(F.theta_difference(b, a)).alias("added"),
        )

    return unions.select(F.inline(F.array(*[counts(name) for name in names])))
