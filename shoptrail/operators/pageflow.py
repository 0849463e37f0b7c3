"""One-step page transitions and the conversion along a target page flow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.runtime import stored

SEED = 42


def slices(actions: DataFrame, tie_break: str | None = "event_id", seed: int = SEED) -> DataFrame:
    """The visits cut into slices that are ordered by session, second and tie, stored once.

    The cut is a range partition, so a session is split wherever it is too big for one task, also inside one
    second; rows keep the number of their slice. Without a ``tie_break`` column, visits of one second are
    ordered by a seeded hash of the whole row, which prefers no page.
    """
    if tie_break is None:
        # Rows that agree in everything lead to the same steps in any order; the number only spreads them.
        tie = F.struct(F.xxhash64(F.lit(seed), *actions.columns), F.monotonically_increasing_id())
    else:
        tie = F.col(tie_break)
    visits = actions.select("session_id", "page_id", F.unix_timestamp("action_time").alias("second"), tie.alias("tie"))
    ranged = visits.repartitionByRange("session_id", "second", "tie")
    return stored(ranged.withColumn("slice", F.spark_partition_id()), "page-visits")


def page_steps(actions: DataFrame, tie_break: str | None = "event_id", seed: int = SEED) -> DataFrame:
    """Consecutive pages of each session as rows ``(from_page, to_page, views)``.

    A row with ``views = 1`` stands for one action; ``to_page`` is null where nothing follows in its slice.
    Steps from a slice to the next of the same session come on top as rows with ``views = 0``; one row per
    session and slice is enough to find them.
    """
    visits = slices(actions, tie_break, seed)
    in_slice = Window.partitionBy("session_id", "slice").orderBy("second", "tie")
    inside = visits.select(
        F.col("page_id").alias("from_page"),
        F.lead("page_id").over(in_slice).alias("to_page"),
        F.lit(1).cast("bigint").alias("views"),
    )
    place = F.struct("second", "tie", "page_id")
    ends = visits.groupBy("session_id", "slice").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    across = ends.select(
        F.col("last.page_id").alias("from_page"),
        F.lead("first.page_id").over(Window.partitionBy("session_id").orderBy("slice")).alias("to_page"),
        F.lit(0).cast("bigint").alias("views"),
    )
    return inside.unionByName(across.where(F.col("to_page").isNotNull()))


def transitions(steps: DataFrame) -> DataFrame:
    """How often each page follows another."""
    followed = steps.where(F.col("to_page").isNotNull())
    return followed.groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("transitions"))


def _flow_pairs(flow: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(flow, flow[1:]))


def _is_pair(pair: tuple[int, int]) -> Column:
    return (F.col("from_page") == pair[0]) & (F.col("to_page") == pair[1])


def conversion(steps: DataFrame, flow: Sequence[int]) -> DataFrame:
    """One row per step of ``flow``: its count, and its rate over the step before.

    The first step is measured against the views of the start page. Everything is counted in one
    aggregate; the table after it has one row per flow step.
    """
    pairs = _flow_pairs(flow)
    if not pairs:
        raise ValueError("a page flow needs at least two pages")
    start = F.col("from_page") == flow[0]
    wanted = reduce(or_, [_is_pair(p) for p in dict.fromkeys(pairs)], start)
    counted = steps.where(wanted).agg(
        F.coalesce(F.sum(F.when(start, F.col("views"))), F.lit(0)).alias("start_views"),
        *[F.count_if(F.coalesce(_is_pair(p), F.lit(False))).alias(f"n{i}") for i, p in enumerate(pairs)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("bigint").alias("step"),
                F.lit(f"{a}_{b}").alias("pair"),
                F.col(f"n{i}").alias("transitions"),
                F.col("start_views" if i == 0 else f"n{i - 1}").alias("previous"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return counted.select(F.inline(rows)).withColumn("rate", C.ratio(F.col("transitions"), F.col("previous")))


def conversion_text(steps_of_flow: DataFrame, digits: int | None = None) -> DataFrame:
    """The whole conversion as one text ``a_b=rate|b_c=rate|...``; a rate over zero is left blank."""
    rate = F.col("rate") if digits is None else F.col("rate").cast(f"decimal(20,{digits})")
    part = F.concat(F.col("pair"), F.lit("="), F.coalesce(rate.cast("string"), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("step", part.alias("text"))))
    return steps_of_flow.agg(F.array_join(F.transform(ordered, lambda s: s["text"]), "|").alias("convert_rate"))
