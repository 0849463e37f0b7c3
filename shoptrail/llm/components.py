"""Connected components of an undirected graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.runtime import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges ``(a, b)`` with a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return (
        small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``(node, root)`` for every node of ``links`` that is not the root, the smallest node of its component.

    ``a`` and ``b`` are two columns of one type; self-links, repeated links and nulls say nothing and are left out.
    Each round is written to the shared folder, so a lost executor costs at most one round; the number of rounds grows
    with the logarithm of the largest component.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges, before = stored(_stars(edges), "links"), state
