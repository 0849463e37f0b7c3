"""Every query of the package, ready to run on a folder of test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.functions import bitmaps
from shoptrail.functions import columns as C
from shoptrail.operators import ads, areas, categories, distributions, pageflow, sampling, sessions
from shoptrail.params import TaskParams
from shoptrail.plans import oracle
from shoptrail.runtime import stored
from shoptrail.sources import layouts
from shoptrail.sources.streams import STAGED_PARTS
from shoptrail.sources.tables import REGION_LEVELS, StarSchema, visit_actions
from shoptrail.streaming import products as stream_products
from shoptrail.streaming.live import run_live
from shoptrail.streaming.products import user_ad_counts

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = TaskParams(
    start_date="2024-01-05",
    end_date="2024-01-24",
    start_age=20,
    end_age=50,
    page_flow=(1, 2, 3, 4, 5, 6, 7),
    sample_size=1500,
    blacklist_threshold=3,
    task_id="registered",
)
_OPEN = PARAMS.replace(start_age=None, end_age=None)
FILTERS = {
    "keywords": _OPEN.replace(keywords=("kw1", "kw7")),
    "categories": _OPEN.replace(category_ids=(3, 11)),
    "professional_city": _OPEN.replace(
        professionals=("professional1", "professional4", "professional8"),
        cities=("NATION_3", "NATION_8", "NATION_14", "NATION_21"),
    ),
    "sex": _OPEN.replace(sex="female"),
    "all": PARAMS.replace(
        professionals=tuple(f"professional{i}" for i in range(8)),
        cities=tuple(f"NATION_{i}" for i in range(20)),
        sex="male",
        keywords=("kw1", "kw3", "kw5", "kw7"),
        category_ids=tuple(range(12)),
    ),
}

TASK_JSON = """{startDate:"2024-01-05", endDate:"2024-01-24", startAge:25, endAge:40, sex:"female",
professionals:"professional1,professional3,professional5", cities:"", keywords:"", categoryIds:"1,2,3,4,5,6,7"}"""

#: Two sets of days that share some, and the shares of which quantiles are taken.
EARLY, LATE = ("early", "2024-01-05", "2024-01-15"), ("late", "2024-01-13", "2024-01-24")
PERMILLES = (100, 500, 900, 990, 1000)

_QUERIES: dict[str, Query] = {}
_AD_COLUMNS = ["ts_ms", "date", "province", "city", "user_id", "adid"]


def _query(function: Query) -> Query:
    """Register a query. Days and hours are defined in UTC."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Expressions take their zone when they are analysed, so it need not stay set.
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return function(spark, folder)
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)

    _QUERIES[function.__name__] = run
    return run


def _time_text(name: str):
    return C.time_text(F.col(name)).alias(name)


def _shown(df: DataFrame) -> DataFrame:
    """Sessions with their start as text."""
    return df.withColumn("start_time", _time_text("start_time"))


def _kept_sessions(spark: SparkSession, folder: str, params: TaskParams = PARAMS) -> DataFrame:
    star = StarSchema(spark, folder)
    return sessions.matching(star.actions(params), star.users(), params)


def _stored_session_ids(spark: SparkSession, folder: str) -> DataFrame:
    return stored(_kept_sessions(spark, folder).select("session_id"), "session-ids")


def _category_counts(spark: SparkSession, folder: str, session_ids: DataFrame) -> DataFrame:
    touching = StarSchema(spark, folder).actions(PARAMS, kinds=["click", "signup", "purchase"])
    return categories.counts(sessions.actions_of(touching, session_ids))


@_query
def actions_by_date(spark: SparkSession, folder: str) -> DataFrame:
    actions = StarSchema(spark, folder).actions(PARAMS)
    return actions.withColumns({"action_sec": F.unix_timestamp("action_time"), "action_time": _time_text("action_time")})


@_query
def session_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(sessions.roll_up(StarSchema(spark, folder).actions(PARAMS)))


@_query
def session_user_profile(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return _shown(sessions.with_users(sessions.roll_up(star.actions(PARAMS)), star.users()))


@_query
def session_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_kept_sessions(spark, folder, FILTERS["all"]))


@_query
def session_filter_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_kept_sessions(spark, folder, FILTERS["keywords"]))


@_query
def session_filter_categories(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_kept_sessions(spark, folder, FILTERS["categories"]))


@_query
def session_filter_professional_city(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_kept_sessions(spark, folder, FILTERS["professional_city"]))


@_query
def session_filter_sex(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_kept_sessions(spark, folder, FILTERS["sex"]))


@_query
def session_visit_length_hist(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.visit_length_bands(_kept_sessions(spark, folder))


@_query
def session_step_length_hist(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.step_length_bands(_kept_sessions(spark, folder))


@_query
def session_ratio_stats(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.ratio_stats(_kept_sessions(spark, folder))


@_query
def session_hour_counts(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.with_day_count(sampling.hour_counts(_kept_sessions(spark, folder)))


@_query
def session_random_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords and categories are gathered for the drawn sessions alone."""
    drawn = stored(sampling.draw(_kept_sessions(spark, folder), PARAMS.sample_size, PARAMS.seed), "drawn-sessions")
    actions = sessions.actions_of(StarSchema(spark, folder).actions(PARAMS), drawn.select("session_id"))
    return _shown(sampling.extract(drawn, sessions.roll_up(actions)))


@_query
def filtered_actions(spark: SparkSession, folder: str) -> DataFrame:
    actions = StarSchema(spark, folder).actions(PARAMS)
    kept = sessions.actions_of(actions, _stored_session_ids(spark, folder))
    return kept.withColumn("action_sec", F.unix_timestamp("action_time")).drop("action_time")


@_query
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _category_counts(spark, folder, _stored_session_ids(spark, folder))


@_query
def category_top10(spark: SparkSession, folder: str) -> DataFrame:
    return categories.top(category_counts(spark, folder), PARAMS.top_categories)


@_query
def category_top10_sessions(spark: SparkSession, folder: str) -> DataFrame:
    session_ids = _stored_session_ids(spark, folder)
    popular = categories.top(_category_counts(spark, folder, session_ids), PARAMS.top_categories)
    clicks = StarSchema(spark, folder).actions(PARAMS, kinds=["click"])
    return categories.top_sessions(clicks, popular, PARAMS.top_sessions, session_ids)


@_query
def page_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return pageflow.transitions(pageflow.page_steps(StarSchema(spark, folder).actions(PARAMS)))


@_query
def page_flow_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return pageflow.conversion(pageflow.page_steps(StarSchema(spark, folder).actions(PARAMS)), PARAMS.page_flow)


@_query
def page_flow_conversion_string(spark: SparkSession, folder: str) -> DataFrame:
    return pageflow.conversion_text(page_flow_conversion(spark, folder), digits=6)


@_query
def area_product_clicks(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return areas.product_clicks(star.actions(PARAMS, kinds=["click"]), star.areas())


@_query
def area_product_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return areas.with_products(area_product_clicks(spark, folder), StarSchema(spark, folder).products())


@_query
def area_top3_products(spark: SparkSession, folder: str) -> DataFrame:
    return areas.top_products(area_product_enriched(spark, folder), REGION_LEVELS, PARAMS.top_products)


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ads.parse(StarSchema(spark, folder).ad_lines())


@_query
def ad_clicks_parsed(spark: SparkSession, folder: str) -> DataFrame:
    return _clicks(spark, folder).select(*_AD_COLUMNS)


@_query
def ad_user_click_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ads.user_ad_counts(_clicks(spark, folder))


@_query
def ad_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return ads.blacklist(ad_user_click_counts(spark, folder), PARAMS.blacklist_threshold)


def _stored_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return stored(ad_blacklist(spark, folder), "blacklist")


def _stored_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return stored(bitmaps.bitmaps(ad_blacklist(spark, folder)), "blacklist")


def _good_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ads.without_listed(_clicks(spark, folder), _stored_blacklist(spark, folder))


@_query
def ad_clicks_not_blacklisted(spark: SparkSession, folder: str) -> DataFrame:
    """The list as bitmaps: one bit decides about a click."""
    return bitmaps.without(_clicks(spark, folder), _stored_bitmaps(spark, folder)).select(*_AD_COLUMNS)


@_query
def ad_blacklist_replay(spark: SparkSession, folder: str) -> DataFrame:
    return ads.replay(_clicks(spark, folder), PARAMS.blacklist_threshold).select(*_AD_COLUMNS)


@_query
def ad_province_city_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ads.place_counts(_good_clicks(spark, folder))


@_query
def ad_province_top3(spark: SparkSession, folder: str) -> DataFrame:
    return ads.province_top(ad_province_city_counts(spark, folder), PARAMS.top_ads)


@_query
def ad_click_trend_minute(spark: SparkSession, folder: str) -> DataFrame:
    return ads.minute_counts(_good_clicks(spark, folder))


@_query
def ad_click_sliding_hour(spark: SparkSession, folder: str) -> DataFrame:
    slid = ads.sliding_counts(_good_clicks(spark, folder))
    return slid.withColumn("window_start", _time_text("window_start"))


@_query
def session_filter_task_json(spark: SparkSession, folder: str) -> DataFrame:
    """The parameters as a task description gives them."""
    return _shown(_kept_sessions(spark, folder, TaskParams.from_json(spark, TASK_JSON)))


@_query
def actions_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """Times as the catalog may hold them: text, with one-digit hours."""
    actions = StarSchema(spark, folder).actions(PARAMS)
    as_text = actions.withColumn("action_time", F.date_format("action_time", "yyyy-MM-dd H:mm:ss"))
    view = f"visit_actions_as_text_{uuid.uuid4().hex}"
    as_text.createOrReplaceTempView(view)
    time = F.col("action_time")
    try:
        return visit_actions(spark, view).select(
            "event_id",
            "session_id",
            F.unix_timestamp(time).alias("action_sec"),
            C.date_hour(time).alias("date_hour"),
            C.minute_key(time).alias("minute_key"),
        )
    finally:
        spark.catalog.dropTempView(view)


@_query
def session_length_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Two periods from one table of sketches per day."""
    lengths = stored(distributions.lengths(_kept_sessions(spark, folder)), "session-lengths")
    sketches = stored(distributions.length_sketches(lengths), "length-sketches")
    return distributions.quantiles(lengths, distributions.merged(sketches, (EARLY, LATE)), PERMILLES)


@_query
def distinct_by_period(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions, users and users that exceeded the blacklist's threshold on some of the days, from sketches per day."""
    visits = StarSchema(spark, folder).actions(PARAMS).select("date", "session_id", "user_id")
    counts = ad_user_click_counts(spark, folder)
    listed = counts.where(F.col("click_count") > PARAMS.blacklist_threshold).select("date", F.col("user_id").alias("listed"))
    names = ["session_id", "user_id", "listed"]
    sketches = distributions.distinct_sketches(visits.unionByName(listed, allowMissingColumns=True), names)
    return distributions.distinct_counts(stored(sketches, "distinct-sketches"), names, EARLY, LATE)


@_query
def visits_of_busy_days(spark: SparkSession, folder: str) -> DataFrame:
    """Visits per page on days with more visits than the mean; the days prune the folders of the saved log at run time."""
    visits = layouts.saved_by_date(StarSchema(spark, folder).actions(PARAMS).select("event_id", "date", "page_id"))
    kept = layouts.of_days(visits, layouts.busy_days(visits))
    return kept.groupBy("date", "page_id").agg(F.count(F.lit(1)).alias("visits"))


@_query
def visits_by_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Two bucketed tables joined bucket by bucket."""
    star = StarSchema(spark, folder)
    visits = star.actions(PARAMS).select("event_id", "user_id", "click_category_id", "pay_category_ids")
    users = star.users().select("user_id", *sessions.PROFILE_COLUMNS)
    return layouts.visits_by_profile(*layouts.co_located(visits, users))


@_query
def stream_ad_province_city_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stream_products.place_counts(spark, folder, _stored_blacklist(spark, folder))


@_query
def stream_ad_province_top3(spark: SparkSession, folder: str) -> DataFrame:
    return stream_products.province_top(spark, folder, _stored_blacklist(spark, folder), PARAMS.top_ads)


@_query
def stream_ad_click_trend_minute(spark: SparkSession, folder: str) -> DataFrame:
    return stream_products.minute_counts(spark, folder, _stored_blacklist(spark, folder))


@_query
def stream_ad_click_sliding_hour(spark: SparkSession, folder: str) -> DataFrame:
    slid = stream_products.sliding_hour(spark, folder, _stored_blacklist(spark, folder))
    return slid.withColumn("window_start", _time_text("window_start"))


@_query
def stream_ad_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return stream_products.blacklist(spark, folder, PARAMS.blacklist_threshold)


@_query
def stream_ad_running_place_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Running sums as the stream's own state, put out in update mode."""
    done = stream_products.run_running_counts(spark, folder, _stored_bitmaps(spark, folder))
    return stream_products.running_totals(spark, done)


@_query
def stream_ad_sliding_hour_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Sliding windows of click time as the stream's own state, put out in update mode."""
    done = stream_products.run_sliding_counts(spark, folder, _stored_bitmaps(spark, folder))
    return stream_products.window_totals(spark, done).withColumn("window_start", _time_text("window_start"))


@_query
def stream_ad_state_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the state itself holds at the end."""
    done = stream_products.run_running_counts(spark, folder, _stored_bitmaps(spark, folder))
    return stream_products.state_rows(spark, done)


@_query
def stream_ad_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, malformed lines and filtered clicks of each batch, counted while the stream runs."""
    return stream_products.batch_counters(spark, folder, _stored_bitmaps(spark, folder))


@_query
def stream_ad_live_user_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole application with its feedback: clicks of listed users stop counting with the next file."""
    return user_ad_counts(spark, run_live(spark, folder, PARAMS))


@_query
def stream_ad_live_province_top3(spark: SparkSession, folder: str) -> DataFrame:
    return stream_products.top_rows(spark, run_live(spark, folder, PARAMS))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.build(PARAMS, FILTERS, STAGED_PARTS, (EARLY, LATE), PERMILLES)
