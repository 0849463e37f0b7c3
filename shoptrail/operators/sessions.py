"""Sessions: roll-up, user attributes, filtering and length distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.functions import predicates as P
from shoptrail.params import TaskParams

# Bands of visit length in seconds, (name, from, to).
VISIT_BANDS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]

# Bands of step length in actions, (name, from, to).
STEP_BANDS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]

PROFILE_COLUMNS = ["age", "professional", "sex", "city"]


def roll_up(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per session.

    Every aggregate combines on the map side, so a session of any size costs a task only its partial
    rows. Keyword and category conditions become one flag each; the sets are dropped by the optimizer
    where a caller does not read them.
    """
    keyword = F.when(C.not_empty(F.col("search_keyword")), F.col("search_keyword"))
    category = F.when(F.col("click_category_id") != -1, F.col("click_category_id"))
    flags = []
    if params is not None:
        for name, condition in (
            ("keyword_hit", P.one_of(keyword, params.keywords)),
            ("category_hit", P.one_of(category, params.category_ids)),
        ):
            if condition is not None:
                flags.append(F.coalesce(F.bool_or(condition), F.lit(False)).alias(name))
    grouped = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        F.collect_set(keyword).alias("keywords"),
        F.collect_set(category).alias("categories"),
        *flags,
    )
    return grouped.select(
        "session_id",
        "user_id",
        "start_time",
        C.seconds_between(F.col("start_time"), F.col("end_time")).alias("visit_length"),
        "step_length",
        C.joined(F.array_sort("keywords")).alias("search_keywords"),
        C.joined(F.array_sort("categories").cast("array<string>")).alias("click_category_ids"),
        *[f for f in ("keyword_hit", "category_hit") if f in grouped.columns],
    )


def with_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's attributes; sessions of unknown users drop out.

    No broadcast is forced: users grow with the shop, so the size check is left to Spark, which also
    splits a user that owns many sessions at run time.
    """
    return sessions.join(users.select("user_id", *PROFILE_COLUMNS), "user_id")


def matching(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that meet all conditions of the task. User conditions act before the join."""
    sessions = roll_up(actions, params)
    flags = [f for f in ("keyword_hit", "category_hit") if f in sessions.columns]
    kept = P.keep(sessions, [F.col(f) for f in flags]).drop(*flags)
    return with_users(kept, P.keep(users, P.user_conditions(params)))


def actions_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The actions that belong to the given sessions.

    Pass sessions that lie in a table: then their size is known, and a session with very many actions
    can be split, which Spark does only where both sides of the join come straight from a shuffle.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def _band_count(length: Column, low: int, high: int | None) -> Column:
    return F.count_if(length >= low if high is None else length.between(low, high))


def _band_rows(sessions: DataFrame, length: str, bands) -> DataFrame:
    counts = sessions.agg(*[_band_count(F.col(length), lo, hi).alias(name) for name, lo, hi in bands])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("band"),
                F.lit(lo).cast("bigint").alias("low"),
                F.lit(-1 if hi is None else hi).cast("bigint").alias("high"),
                F.col(name).alias("sessions"),
            )
            for name, lo, hi in bands
        ]
    )
    return counts.select(F.inline(rows))


def visit_length_bands(sessions: DataFrame) -> DataFrame:
    """Sessions per band of visit length; ``high`` is -1 for the open band."""
    return _band_rows(sessions, "visit_length", VISIT_BANDS)


def step_length_bands(sessions: DataFrame) -> DataFrame:
    return _band_rows(sessions, "step_length", STEP_BANDS)


def counters() -> list[Column]:
    """The named counters of a session set, as aggregate columns."""
    visits = [_band_count(F.col("visit_length"), lo, hi).alias(f"visit_length_{n}") for n, lo, hi in VISIT_BANDS]
    steps = [_band_count(F.col("step_length"), lo, hi).alias(f"step_length_{n}") for n, lo, hi in STEP_BANDS]
    return [F.count(F.lit(1)).alias("session_count"), *visits, *steps]


def observed(sessions: DataFrame, observation: Observation) -> DataFrame:
    """The same sessions; the counters become readable once an action has run over them."""
    return sessions.observe(observation, *counters())


def ratio_stats(sessions: DataFrame) -> DataFrame:
    """One row: session count and the share of each band, to two places. No session gives zeros."""
    counted = sessions.agg(*counters())
    total = F.col("session_count")
    shares = [
        F.coalesce(C.ratio(F.col(name), total, 2), F.lit(0.0)).alias(f"{name}_ratio")
        for name in counted.columns
        if name != "session_count"
    ]
    return counted.select(total, *shares)
