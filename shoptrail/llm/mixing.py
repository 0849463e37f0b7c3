"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is met by whole passes over all its documents and a remaining budget. The budget is fitted on the
histogram of exact document sizes: every size first gives its proportional share of documents, what is left is filled from
the largest size down, and a bounded-knapsack dynamic programme over the last ``DP_BUDGET`` words closes the gap; where documents
are longer than that, over as many ranges of sums. Which
documents of a size are taken is decided by a seeded hash. Only histograms (source, size, count) reach the fitting; the
number of different sizes k of a source is bounded by its words, as k(k-1)/2 <= words.

Sizes are whitespace-separated words, null and empty texts have size 0 and take nothing. A null source is a source of its
own, ordered last. Rows that agree in id, source and size are interchangeable.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptrail.runtime import stored

#: Weights of the sources in order of code points, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix, as a share of all words.
SHARE = 1.5
#: A source gives at most so many times its own words, a document at most so many times its size.
MOST = 2
#: The dynamic programme runs over at most so many words.
DP_BUDGET = 1 << 16
#: Where documents are too long for that, it runs over as many ranges of sums, on a gap of so many of the longest documents.
LONGEST_LEFT = 32
SEED = 42
#: Documents of one size and source that are ranked together; larger groups are cut by ranges of the seeded hash.
RANKED_TOGETHER = 1_000

_HASH_RANGE = 1 << 62


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source: ``source_size``, ``weight`` and ``target``; ``sizes`` has one row per source and size with ``n``.

    Ranks come from a range partition, so no task holds all sources; each round of resharing is one aggregate whose two
    sums are all that reaches the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    ranged = stored(totals.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    within = ranged.withColumn("place", F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1)
    before = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    rank = (F.col("place") + F.col("before")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int"))
    ranked = stored(within.join(parts, "part").select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * most
    whole = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full, open_weight = 0.0, 0.0, float(ranked.agg(F.sum("weight")).first()[0] or 0)
    while open_weight > 0:
        level = max(whole - full, 0.0) / open_weight
        above = F.col("weight") * level > cap
        sums = ranked.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        state = (float(sums[0] or 0), float(sums[1] or 0))
        if state == (full, open_weight):
            break
        full, open_weight = state
    return ranked.select("source", "source_size", F.least(F.col("weight") * level, cap.cast("double")).alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, dp_budget: int = DP_BUDGET) -> np.ndarray:
    """How many documents of each (positive, distinct) size to take so that the words come near ``budget``.

    Exact when the dynamic programme can reach the remaining budget, otherwise a sum below it: the nearest one if the
    programme sees all that is left, and for documents too long for that one that ``_nearest`` finds.
    """
    order = np.argsort(-sizes)
    size, count = sizes[order].astype(object), counts[order].astype(object)
    whole = sum(s * c for s, c in zip(size, count))
    if budget >= whole:
        return counts.copy()
    take = [c * budget // whole for c in count]
    left = budget - sum(s * t for s, t in zip(size, take))
    shares, open_words = list(take), left
    for k, s in enumerate(size):
        if left <= dp_budget:
            break
        more = min(count[k] - take[k], (left - dp_budget // 2) // s)
        take[k] += max(more, 0)
        left -= max(more, 0) * s
    # Beyond the programme's reach only long documents are free; the largest that fits goes in.
    for k, s in enumerate(size):
        if left <= dp_budget:
            break
        more = min(count[k] - take[k], left // s)
        take[k] += more
        left -= more * s
    left = int(left)
    if 0 < left <= dp_budget:
        # first[v]: number of the item with which v was first reached; items are sizes times powers of two.
        first = np.full(left + 1, -1, np.int64)
        reached = np.zeros(left + 1, bool)
        reached[0] = True
        items: list[tuple[int, int]] = []
        for k in range(len(size) - 1, -1, -1):
            s, free = int(size[k]), int(min(count[k] - take[k], left // size[k]))
            step = 1
            while free > 0 and not reached[left]:
                many = min(step, free)
                free, step = free - many, step * 2
                w = many * s
                new = np.zeros(left + 1, bool)
                new[w:] = reached[: left + 1 - w]
                new &= ~reached
                if new.any():
                    first[new] = len(items)
                    reached |= new
                items.append((k, many))
            if reached[left]:
                break
        v = int(np.flatnonzero(reached)[-1])
        while v:
            k, many = items[first[v]]
            take[k] += many
            v -= many * int(size[k])
    if open_words > dp_budget and sum(s * t for s, t in zip(size, take)) < budget:
        free = [c - t for c, t in zip(count, shares)]
        other = _best_of_few(size, free, open_words, dp_budget) or _nearest(size, free, open_words, dp_budget)
        other = [t + b for t, b in zip(shares, other)]
        take = max(take, other, key=lambda t: sum(s * n for s, n in zip(size, t)))
    out = np.zeros(len(sizes), np.int64)
    out[order] = take
    return out


def _best_of_few(size, free, budget: int, most_sums: int) -> list[int] | None:
    """The numbers of documents with the largest sum up to ``budget``, or None if more than ``most_sums`` sums are possible."""
    came: dict[int, tuple[int, int]] = {0: (-1, 0)}
    for k, s in enumerate(size):
        for before in list(came):
            for many in range(1, int(min(free[k], (budget - before) // s)) + 1):
                came.setdefault(before + many * s, (k, many))
                if len(came) > most_sums:
                    return None
    take, v = [0] * len(size), max(came)
    while v:
        k, many = came[v]
        take[k], v = take[k] + many, v - many * size[k]
    return take


def _nearest(size, free, budget: int, buckets: int) -> list[int]:
    """The numbers of documents with a sum close below ``budget``, for documents too long to close a small gap with.

    The largest go first until the gap is ``LONGEST_LEFT`` of them; the programme then runs over ``buckets`` ranges of sums and
    keeps the largest sum of each, so it is exact for gaps up to ``buckets`` words and stops at an exact fit.
    """
    take, left = [0] * len(size), int(budget)
    for k, s in enumerate(size):
        take[k] = int(max(0, min(free[k], (left - LONGEST_LEFT * size[0]) // s)))
        left -= take[k] * int(s)
    unit = max(1, -(-left // buckets))
    sums = np.full(left // unit + 1, -1, np.int64)
    sums[0] = 0
    # Every sum that was ever kept has a number; a step's numbers follow each other.
    number, begins, steps, total = np.zeros(len(sums), np.int64), [], [], 1
    for k in range(len(size)):
        rest, many = int(min(free[k] - take[k], left // size[k])), 1
        while rest > 0 and sums[-1] < left:
            many = min(many, rest)
            old = np.flatnonzero(sums >= 0)
            new = sums[old] + many * int(size[k])
            old, new = old[new <= left], new[new <= left]
            to = new // unit
            keep = np.append(to[1:] != to[:-1], True)[: len(to)] & (new > sums[to])
            begins.append(total)
            steps.append((k, many, number[old[keep]]))
            sums[to[keep]], number[to[keep]] = new[keep], total + np.arange(keep.sum())
            total += int(keep.sum())
            rest, many = rest - many, many * 2
    at = int(number[np.flatnonzero(sums >= 0)[-1]])
    while at:
        step = bisect.bisect_right(begins, at) - 1
        k, many, came_from = steps[step]
        take[k] += many
        at = int(came_from[at - begins[step]])
    return take


def quotas(sizes: DataFrame, goals: DataFrame, most: int = MOST, dp_budget: int = DP_BUDGET) -> DataFrame:
    """Per source and size: ``passes`` over all documents and ``extra``, the documents taken once more."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, goal = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        passes = min(int(goal // own), most) if own else 0
        positive = rows["size"].to_numpy() > 0
        extra = np.zeros(len(rows), np.int64)
        if own and passes < most:
            extra[positive] = fit(rows["size"].to_numpy()[positive], rows["n"].to_numpy()[positive], round(goal - passes * own), dp_budget)
        return rows[["source_key", "size"]].assign(n=rows["n"], passes=passes, extra=extra)

    key = F.to_json(F.struct("source")).alias("source_key")
    rows = sizes.select(key, "size", "n").join(goals.select(key, "source_size", "target"), "source_key")
    return rows.groupBy("source_key").applyInPandas(run, "source_key string, size long, n long, passes int, extra long")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, ``taken`` (the words that the mix takes from it) and ``row_id``."""
    key = F.to_json(F.struct("source")).alias("source_key")
    rows = docs.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
    rows = stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "sizes")
    sizes = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "size counts")
    goals = stored(targets(sizes), "targets")
    plan = quotas(sizes, goals).join(goals.select(key, "source_size", "target"), "source_key")
    # Documents of one source and size beyond RANKED_TOGETHER are cut into cells by the hash, which are ranked apart.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "source_key", "size"), 2)
    cells = F.ceil(F.col("n") / RANKED_TOGETHER)
    cell = F.when(F.col("extra").between(1, F.col("n") - 1), F.floor(F.col("draw") / (F.lit(float(_HASH_RANGE)) / cells)))
    planned = rows.select("id", "row_id", key, "size").join(stored(plan, "quotas"), ["source_key", "size"])
    planned = stored(planned.withColumn("draw", draw).withColumn("cell", cell), "planned")
    group = ["source_key", "size", "cell"]
    drawn = planned.where("cell is not null")
    before = F.sum("in_cell").over(W.partitionBy("source_key", "size").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    cut = drawn.groupBy(*group, "extra").agg(F.count("*").alias("in_cell"))
    cut = cut.select(*group, (F.col("extra") - F.coalesce(before, F.lit(0))).alias("wanted")).where("wanted > 0")
    place = F.row_number().over(W.partitionBy(*group).orderBy("draw", "id", "row_id"))
    chosen = drawn.select(*group, "draw", "id", "row_id").withColumn("place", place).join(stored(cut, "cells"), group)
    chosen = chosen.where("place <= wanted").select("row_id", F.lit(1).alias("chosen"))
    times = F.col("passes") + F.when(F.col("extra") == F.col("n"), 1).otherwise(F.coalesce("chosen", F.lit(0)))
    return planned.join(chosen, "row_id", "left").select(
        F.col("id").alias(id), "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), "row_id"
    )


def query(documents: DataFrame) -> DataFrame:
    return mixed(documents).drop("row_id")
