"""The finished reports: column layout of each result table, and the jobs that fill them.

Names of result tables and columns are fixed values: whoever reads the reports relies on them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shoptrail.functions import predicates as P
from shoptrail.operators import areas, categories, pageflow, sampling, sessions
from shoptrail.params import TaskParams
from shoptrail.runtime import stored, temporary_tables

Sink = Callable[[DataFrame, str], None]


def _report(df: DataFrame, params: TaskParams, columns: Mapping[str, str | Column]) -> DataFrame:
    chosen = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return df.select(F.lit(params.task_id).alias("taskid"), *chosen)


def session_stat_ratio(kept: DataFrame, params: TaskParams) -> DataFrame:
    stats = sessions.ratio_stats(kept)
    return _report(stats, params, {c: c for c in stats.columns})


def session_extract(kept: DataFrame, params: TaskParams) -> DataFrame:
    drawn = sampling.extract(stored(sampling.draw(kept, params.sample_size, params.seed), "drawn-sessions"), kept)
    return _report(
        drawn,
        params,
        {
            "sessionid": "session_id",
            "startTime": F.date_format("start_time", "yyyy-MM-dd HH:mm:ss"),
            "searchKeywords": "search_keywords",
            "clickCategoryIds": "click_category_ids",
        },
    )


def top_categories(popular: DataFrame, params: TaskParams) -> DataFrame:
    return _report(
        popular,
        params,
        {
            "categoryid": "category_id",
            "clickCount": "click_count",
            "orderCount": "order_count",
            "payCount": "pay_count",
        },
    )


def top_sessions_per_category(ranked: DataFrame, params: TaskParams) -> DataFrame:
    return _report(
        ranked, params, {"categoryid": "category_id", "sessionid": "session_id", "clickCount": "click_count"}
    )


def page_skip_ratio(converted: DataFrame, params: TaskParams) -> DataFrame:
    return _report(pageflow.conversion_text(converted), params, {"convertRate": "convert_rate"})


def area_top_products(ranked: DataFrame, params: TaskParams) -> DataFrame:
    return _report(
        ranked,
        params,
        {
            "area": "area",
            "areaLevel": "area_level",
            "productid": "product_id",
            "cityInfos": "city_infos",
            "clickCount": "click_count",
            "productName": "product_name",
            "productStatus": "product_status",
        },
    )


def run_session_job(actions: DataFrame, users: DataFrame, params: TaskParams, sink: Sink) -> dict[str, int]:
    """Fill the four session reports. Returns the session counters.

    The matching sessions feed all four, so they are written to the shared folder once; the counters are
    observed while that happens. The popular categories are stored as well, a few rows.
    """
    with temporary_tables(actions.sparkSession):
        actions = P.in_period(actions, params)
        counters = Observation("session counters")
        kept = stored(sessions.observed(sessions.matching(actions, users, params), counters), "sessions")
        sink(session_stat_ratio(kept, params), "session_stat_ratio")
        sink(session_extract(kept, params), "session_extract")
        counted = categories.counts(sessions.actions_of(actions, kept))
        popular = stored(categories.top(counted, params.top_categories), "top-categories")
        sink(top_categories(popular, params), "top_categories")
        ranked = categories.top_sessions(actions, popular, params.top_sessions, kept)
        sink(top_sessions_per_category(ranked, params), "top_sessions_per_category")
        return counters.get


def run_page_flow_job(actions: DataFrame, params: TaskParams, sink: Sink, tie_break: str | None = None) -> None:
    """Fill the page conversion report.

    Visits of one second are ordered by the column ``tie_break`` or, without one, by a seeded hash of the row.
    """
    with temporary_tables(actions.sparkSession):
        steps = pageflow.page_steps(P.in_period(actions, params), tie_break, params.seed)
        sink(page_skip_ratio(pageflow.conversion(steps, params.page_flow), params), "page_skip_ratio")


def run_area_job(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    levels: Mapping[str, str],
    params: TaskParams,
    sink: Sink,
) -> None:
    """Fill the report of top products per area."""
    clicks = areas.product_clicks(P.in_period(actions, params), cities)
    ranked = areas.top_products(areas.with_products(clicks, products), levels, params.top_products)
    sink(area_top_products(ranked, params), "area_top_products")
