"""Category popularity and the most active sessions of the popular categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.operators.ranking import top_per_group


def counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category in one pass; a kind that never occurs counts 0."""
    clicked, ordered, paid = F.col("click_category_id"), F.col("order_category_ids"), F.col("pay_category_ids")

    def tagged(ids, kind):
        return F.transform(ids, lambda i: F.struct(i.alias("category_id"), F.lit(kind).alias("kind")))

    none = F.array().cast("array<struct<category_id:bigint,kind:string>>")
    touched = F.concat(
        F.when(clicked != -1, tagged(F.array(clicked), "click")).otherwise(none),
        F.coalesce(tagged(C.id_list(ordered), "order"), none),
        F.coalesce(tagged(C.id_list(paid), "pay"), none),
    )
    relevant = actions.where((clicked != -1) | ordered.isNotNull() | paid.isNotNull())
    return (
        relevant.select(F.inline(touched))
        .groupBy("category_id")
        .agg(
            F.count_if(F.col("kind") == "click").alias("click_count"),
            F.count_if(F.col("kind") == "order").alias("order_count"),
            F.count_if(F.col("kind") == "pay").alias("pay_count"),
        )
    )


def top(category_counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` first categories by clicks, then orders, then payments."""
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return category_counts.orderBy(*order).limit(n)


def top_sessions(
    actions: DataFrame, top_categories: DataFrame, n: int = 10, sessions: DataFrame | None = None
) -> DataFrame:
    """Per given category the ``n`` sessions that clicked it most, among ``sessions`` when given.

    ``top_categories`` is the result of :func:`top`, a handful of rows by its own limit, so the
    broadcast stays small whatever the data. Clicks are counted before sessions are selected: a session
    with very many clicks then meets the join as one row per category.
    """
    category = F.col("click_category_id").alias("category_id")
    clicks = actions.where(F.col("click_category_id") != -1).select(category, "session_id")
    per_session = (
        clicks.join(F.broadcast(top_categories.select("category_id")), "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    if sessions is not None:
        per_session = per_session.join(sessions.select("session_id"), "session_id", "left_semi")
    order = [F.desc("click_count"), F.asc("session_id")]
    return top_per_group(per_session, ["category_id"], order, n).select(
        "category_id", "session_id", "click_count", "rank"
    )
