"""DuckDB SQL for every registered query, written independently of the Spark plans."""

from __future__ import annotations

from shoptrail.params import TaskParams

_BASE = """
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(props->>'k' AS BIGINT) AS k,
         strftime(ts, '%Y-%m-%d') AS date,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS day_no,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS sod
  FROM events),
all_actions AS (
  SELECT event_id, date, user_id, user_id || '_' || date AS session_id, k % 10 AS page_id,
         day_no * 86400 + (user_id % 24) * 3600 + sod // 25 AS action_sec,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN (k % 20) || ',' || ((k + 1) % 20) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id
  FROM ev),
actions AS (SELECT * FROM all_actions WHERE date BETWEEN '{start_date}' AND '{end_date}'),
user_info AS (
  SELECT c_custkey AS user_id, CAST(c_custkey % 60 AS INTEGER) AS age,
         'professional' || (c_custkey % 10) AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, '{{"product_status": ' || (p_partkey % 2) || '}}' AS extend_info
  FROM part),
areas AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
summary AS (
  SELECT session_id, min(user_id) AS user_id, min(action_sec) AS start_sec,
         max(action_sec) - min(action_sec) AS visit_length, count(*) AS step_length,
         list_sort(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL)) AS kws,
         list_sort(list(DISTINCT click_category_id) FILTER (click_category_id <> -1)) AS cats
  FROM actions GROUP BY session_id),
session_rows AS (
  SELECT session_id, s.user_id, strftime(make_timestamp(start_sec * 1000000), '%Y-%m-%d %H:%M:%S') AS start_time,
         visit_length, step_length, array_to_string(kws, ',') AS search_keywords,
         array_to_string(cats, ',') AS click_category_ids, start_sec, kws, cats
  FROM summary s),
profiles AS (
  SELECT r.*, age, professional, sex, city FROM session_rows r JOIN user_info u ON r.user_id = u.user_id),
kept AS (SELECT * FROM profiles WHERE age BETWEEN {start_age} AND {end_age}),
kept_actions AS (SELECT a.* FROM actions a WHERE session_id IN (SELECT session_id FROM kept))
"""

_CATEGORIES = """,
category_hits AS (
  SELECT click_category_id AS category_id, 'c' AS kind FROM kept_actions WHERE click_category_id <> -1
  UNION ALL
  SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'o' FROM kept_actions
   WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'p' FROM kept_actions
   WHERE pay_category_ids IS NOT NULL),
category_counts AS (
  SELECT category_id, count(*) FILTER (kind = 'c') AS click_count, count(*) FILTER (kind = 'o') AS order_count,
         count(*) FILTER (kind = 'p') AS pay_count
  FROM category_hits GROUP BY category_id),
category_top AS (
  SELECT * FROM category_counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)
"""

_PAGES = """,
pairs AS (
  SELECT page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_sec, event_id) AS to_page
  FROM actions),
flow AS (SELECT * FROM (VALUES {flow}) f(step, from_page, to_page)),
flow_counts AS (
  SELECT f.step, f.from_page || '_' || f.to_page AS pair, count(p.from_page) AS transitions
  FROM flow f LEFT JOIN pairs p ON f.from_page = p.from_page AND f.to_page = p.to_page
  GROUP BY f.step, f.from_page, f.to_page),
flow_rates AS (
  SELECT step, pair, transitions,
         coalesce(lag(transitions) OVER (ORDER BY step),
                  (SELECT count(*) FROM actions WHERE page_id = {first_page})) AS previous
  FROM flow_counts)
"""

_AREAS = """,
area_clicks AS (
  SELECT area, click_product_id AS product_id, count(*) AS click_count,
         string_agg(DISTINCT a.city_id || ':' || city_name, ',' ORDER BY a.city_id || ':' || city_name) AS city_infos
  FROM actions a JOIN areas d ON a.city_id = d.city_id WHERE click_product_id <> -1 GROUP BY area, click_product_id),
area_full AS (
  SELECT c.*, product_name,
         CASE WHEN extend_info->>'product_status' = '0' THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM area_clicks c JOIN product_info p ON c.product_id = p.product_id)
"""

_ADS = """
ev AS (
  SELECT event_id, ts, user_id, CAST(props->>'k' AS BIGINT) AS k,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS day_no,
         CAST((hour(ts) * 3600 + minute(ts) * 60) * 1000 + millisecond(ts) AS BIGINT) AS mod_ms
  FROM events),
lines AS (
  SELECT event_id, day_no * 86400000 + mod_ms // 24 AS ts_ms, CAST(n_regionkey AS VARCHAR) AS province,
         CAST(n_nationkey AS VARCHAR) AS city, user_id, k % 5 AS adid
  FROM ev JOIN nation ON user_id % 25 = n_nationkey),
clicks AS (
  SELECT *, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS date,
         ts_ms || ' ' || province || ' ' || city || ' ' || user_id || ' ' || adid AS line
  FROM lines),
user_ad AS (SELECT date, user_id, adid, count(*) AS click_count FROM clicks GROUP BY date, user_id, adid),
listed AS (SELECT DISTINCT user_id FROM user_ad WHERE click_count > {blacklist_threshold}),
good AS (SELECT * FROM clicks WHERE user_id NOT IN (SELECT user_id FROM listed)),
places AS (
  SELECT date, province, city, adid, count(*) AS click_count FROM good GROUP BY date, province, city, adid),
provinces AS (
  SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count
  FROM places GROUP BY date, province, adid),
minutes AS (
  SELECT strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS date,
         strftime(make_timestamp(ts_ms * 1000), '%H') AS hour,
         strftime(make_timestamp(ts_ms * 1000), '%M') AS minute, adid, count(*) AS click_count
  FROM good GROUP BY ALL)
"""

# The bands, written out here so that a wrong edge in the operators shows.
VISIT_BANDS = [
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
    ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None),
]
STEP_BANDS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]

# The live application over the staged files: a user's clicks count up to and including the file with which an ad
# of a day exceeds the threshold.
_LIVE = """,
numbered AS (
  SELECT c.*, greatest(coalesce((event_id * {files}) // ((SELECT max(event_id) FROM events) + 1), 0), 0) AS file FROM clicks c),
per_file AS (SELECT date, user_id, adid, file, count(*) AS n FROM numbered GROUP BY ALL),
running AS (SELECT *, sum(n) OVER (PARTITION BY date, user_id, adid ORDER BY file) AS upto FROM per_file),
last_file AS (SELECT user_id, min(file) AS last FROM running WHERE upto > {blacklist_threshold} GROUP BY user_id),
admitted AS (
  SELECT n.* FROM numbered n LEFT JOIN last_file l ON n.user_id = l.user_id WHERE l.last IS NULL OR n.file <= l.last)
"""

_SUMMARY_COLUMNS = "session_id, user_id, start_time, visit_length, step_length, search_keywords, click_category_ids"
_PROFILE_COLUMNS = _SUMMARY_COLUMNS + ", age, professional, sex, city"


def _band_rows(length: str, bands) -> str:
    selects = []
    for name, low, high in bands:
        condition = f"{length} >= {low}" + (f" AND {length} <= {high}" if high is not None else "")
        selects.append(
            f"SELECT '{name}' AS band, CAST({low} AS BIGINT) AS low, "
            f"CAST({-1 if high is None else high} AS BIGINT) AS high, "
            f"count(*) FILTER ({condition}) AS sessions FROM kept"
        )
    return " UNION ALL ".join(selects)


def _ratio_columns() -> str:
    parts = []
    for length, bands in (("visit_length", VISIT_BANDS), ("step_length", STEP_BANDS)):
        for name, low, high in bands:
            condition = f"{length} >= {low}" + (f" AND {length} <= {high}" if high is not None else "")
            count = f"count(*) FILTER ({condition})"
            parts.append(
                f"coalesce(((200 * {count} + count(*)) // nullif(2 * count(*), 0)) / 100.0::DOUBLE, 0) "
                f"AS {length}_{name}_ratio"
            )
    return ", ".join(parts)


def build(params: TaskParams, filters: dict[str, TaskParams], files: int, periods, permilles) -> dict[str, str]:
    """SQL per query key. ``filters`` holds the parameters of the single-condition queries."""
    base = "WITH " + _BASE.format(
        start_date=params.start_date, end_date=params.end_date, start_age=params.start_age, end_age=params.end_age
    )
    ads = "WITH " + _ADS.format(blacklist_threshold=params.blacklist_threshold)
    live = ads + _LIVE.format(files=files, blacklist_threshold=params.blacklist_threshold)
    flow = ", ".join(f"({i + 1}::BIGINT, {a}, {b})" for i, (a, b) in enumerate(zip(params.page_flow, params.page_flow[1:])))
    pages = base + _PAGES.format(flow=flow, first_page=params.page_flow[0])
    categories = base + _CATEGORIES
    areas = base + _AREAS
    n, threshold = params.sample_size, params.blacklist_threshold

    def quoted(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    by_keyword, by_category = filters["keywords"], filters["categories"]
    by_place, by_sex = filters["professional_city"], filters["sex"]
    everything = filters["all"]
    age = f"age BETWEEN {everything.start_age} AND {everything.end_age}"

    def category_list(p: TaskParams) -> str:
        return ", ".join(str(c) for c in p.category_ids)

    sql = {
        "actions_by_date": base
        + """SELECT event_id, date, user_id, session_id, page_id,
             strftime(make_timestamp(action_sec * 1000000), '%Y-%m-%d %H:%M:%S') AS action_time, action_sec,
             search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
             pay_category_ids, pay_product_ids, city_id FROM actions""",
        "session_summary": base + f"SELECT {_SUMMARY_COLUMNS} FROM session_rows",
        "session_user_profile": base + f"SELECT {_PROFILE_COLUMNS} FROM profiles",
        "session_filtered": base
        + f"""SELECT {_PROFILE_COLUMNS} FROM profiles WHERE {age}
             AND professional IN ({quoted(everything.professionals)}) AND city IN ({quoted(everything.cities)})
             AND sex = '{everything.sex}' AND list_has_any(kws, [{quoted(everything.keywords)}])
             AND list_has_any(cats, [{category_list(everything)}])""",
        "session_filter_keywords": base
        + f"SELECT {_PROFILE_COLUMNS} FROM profiles WHERE list_has_any(kws, [{quoted(by_keyword.keywords)}])",
        "session_filter_categories": base
        + f"SELECT {_PROFILE_COLUMNS} FROM profiles WHERE list_has_any(cats, [{category_list(by_category)}])",
        "session_filter_professional_city": base
        + f"""SELECT {_PROFILE_COLUMNS} FROM profiles WHERE professional IN ({quoted(by_place.professionals)})
             AND city IN ({quoted(by_place.cities)})""",
        "session_filter_sex": base + f"SELECT {_PROFILE_COLUMNS} FROM profiles WHERE sex = '{by_sex.sex}'",
        "session_visit_length_hist": base + _band_rows("visit_length", VISIT_BANDS),
        "session_step_length_hist": base + _band_rows("step_length", STEP_BANDS),
        "session_ratio_stats": base + f"SELECT count(*) AS session_count, {_ratio_columns()} FROM kept",
        "session_hour_counts": base
        + """, h AS (
             SELECT start_time[:10] AS date, start_time[12:13] AS hour, count(*) AS sessions FROM kept GROUP BY ALL)
           SELECT *, CAST(sum(sessions) OVER (PARTITION BY date) AS BIGINT) AS day_sessions,
                  (SELECT count(DISTINCT date) FROM h) AS days FROM h""",
        "session_random_extract": base
        + f""", d AS (
             SELECT *, start_time[:10] AS date, start_time[12:13] AS hour,
                    row_number() OVER (PARTITION BY start_time[:13]
                                       ORDER BY md5('{params.seed}:' || session_id), session_id) AS rn,
                    count(*) OVER (PARTITION BY start_time[:13]) AS cnt,
                    count(*) OVER (PARTITION BY start_time[:10]) AS day_cnt FROM kept),
           q AS (
             SELECT *, least(cnt, CAST(floor(CAST(cnt AS DOUBLE) / day_cnt
                    * ({n} // (SELECT count(DISTINCT date) FROM d))) AS BIGINT)) AS quota FROM d)
           SELECT date, hour, session_id, start_time, search_keywords, click_category_ids FROM q WHERE rn <= quota""",
        "filtered_actions": base
        + """SELECT event_id, date, user_id, session_id, page_id, action_sec, search_keyword, click_category_id,
             click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id
             FROM kept_actions""",
        "category_counts": categories + "SELECT * FROM category_counts",
        "category_top10": categories + "SELECT * FROM category_top",
        "category_top10_sessions": categories
        + """, r AS (
             SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM kept_actions
             WHERE click_category_id IN (SELECT category_id FROM category_top) GROUP BY ALL),
           o AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rank
                 FROM r)
           SELECT category_id, session_id, click_count, rank FROM o WHERE rank <= 10""",
        "page_transitions": pages
        + """SELECT from_page, to_page, count(*) AS transitions FROM pairs WHERE to_page IS NOT NULL
             GROUP BY from_page, to_page""",
        "page_flow_conversion": pages
        + """SELECT step, pair, transitions, previous,
             CASE WHEN previous > 0 THEN CAST(transitions AS DOUBLE) / previous END AS rate FROM flow_rates""",
        "page_flow_conversion_string": pages
        + """, m AS (SELECT step, pair, (2000000 * transitions + previous) // nullif(2 * previous, 0) AS v FROM flow_rates)
           SELECT string_agg(pair || '=' || coalesce((v // 1000000) || '.' || lpad(CAST(v % 1000000 AS VARCHAR), 6, '0'), ''),
                             '|' ORDER BY step) AS convert_rate FROM m""",
        "area_product_clicks": areas + "SELECT area, product_id, click_count, city_infos FROM area_clicks",
        "area_product_enriched": areas
        + "SELECT area, product_id, click_count, city_infos, product_name, product_status FROM area_full",
        "area_top3_products": areas
        + """, r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rank
                    FROM area_full)
           SELECT area, CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A_Level' WHEN area = 'ASIA' THEN 'B_Level'
                             WHEN area = 'EUROPE' THEN 'C_Level' END AS area_level,
                  product_id, city_infos, click_count, product_name, product_status, rank FROM r WHERE rank <= 3""",
        "ad_clicks_parsed": ads + "SELECT ts_ms, date, province, city, user_id, adid FROM clicks",
        "ad_user_click_counts": ads + "SELECT date, user_id, adid, click_count FROM user_ad",
        "ad_blacklist": ads + "SELECT user_id FROM listed",
        "ad_clicks_not_blacklisted": ads + "SELECT ts_ms, date, province, city, user_id, adid FROM good",
        "ad_blacklist_replay": ads
        + f""", r AS (
             SELECT *, row_number() OVER (PARTITION BY date, user_id, adid ORDER BY ts_ms, line) AS key_rank,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, line) AS user_rank FROM clicks),
           e AS (SELECT user_id, min(user_rank) AS last_rank FROM r WHERE key_rank = {threshold + 1} GROUP BY user_id)
           SELECT r.ts_ms, r.date, r.province, r.city, r.user_id, r.adid FROM r LEFT JOIN e ON r.user_id = e.user_id
           WHERE e.last_rank IS NULL OR r.user_rank <= e.last_rank""",
        "ad_province_city_counts": ads + "SELECT date, province, city, adid, click_count FROM places",
        "ad_province_top3": ads
        + """, r AS (SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rank
                    FROM provinces)
           SELECT date, province, adid, click_count, rank FROM r WHERE rank <= 3""",
        "ad_click_trend_minute": ads + "SELECT date, hour, minute, adid, click_count FROM minutes",
        "ad_click_sliding_hour": ads
        + """, w AS (SELECT ts_ms // 60000 - unnest(range(60)) AS start_minute, adid FROM good)
           SELECT strftime(make_timestamp(start_minute * 60000000), '%Y-%m-%d %H:%M:%S') AS window_start, adid,
                  count(*) AS click_count FROM w GROUP BY start_minute, adid""",
    }
    for key in ("ad_province_city_counts", "ad_province_top3", "ad_click_trend_minute", "ad_blacklist", "ad_click_sliding_hour"):
        sql["stream_" + key] = sql[key]
    sql["stream_ad_sliding_hour_windows"] = sql["ad_click_sliding_hour"]
    sql["stream_ad_running_place_counts"] = sql["stream_ad_state_rows"] = sql["ad_province_city_counts"]
    sql["stream_ad_counters"] = (
        live
        + """SELECT file AS batch_id, count(*) AS lines, CAST(0 AS BIGINT) AS malformed,
                    count(*) FILTER (WHERE user_id IN (SELECT user_id FROM listed)) AS filtered
             FROM numbered GROUP BY file"""
    )
    sql["stream_ad_live_user_counts"] = (
        live + "SELECT date, user_id, adid, count(*) AS click_count FROM admitted GROUP BY date, user_id, adid"
    )
    sql["stream_ad_live_province_top3"] = (
        live
        + """, p AS (SELECT date, province, adid, count(*) AS click_count FROM admitted GROUP BY ALL),
           r AS (SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rank FROM p)
           SELECT date, province, adid, click_count, rank FROM r WHERE rank <= 3"""
    )
    sql["session_filter_task_json"] = (
        base
        + f"""SELECT {_PROFILE_COLUMNS} FROM profiles WHERE age BETWEEN 25 AND 40 AND sex = 'female'
             AND professional IN ('professional1', 'professional3', 'professional5')
             AND list_has_any(cats, [1, 2, 3, 4, 5, 6, 7])"""
    )
    sql["actions_from_text"] = (
        base
        + """SELECT event_id, session_id, action_sec,
             strftime(make_timestamp(action_sec * 1000000), '%Y-%m-%d_%H') AS date_hour,
             strftime(make_timestamp(action_sec * 1000000), '%Y%m%d%H%M') AS minute_key FROM actions"""
    )
    early, late = (f"date BETWEEN '{first}' AND '{last}'" for _, first, last in periods)
    asked = ", ".join(f"({p}::BIGINT)" for p in permilles)
    sql["session_length_quantiles"] = (
        base
        + f""", l AS (
             SELECT p.period, m.measure, CASE m.measure WHEN 'visit_length' THEN visit_length ELSE step_length END AS length
             FROM kept, (VALUES ('visit_length'), ('step_length')) m(measure),
                  (VALUES {", ".join(str(p) for p in periods)}) p(period, first, last)
             WHERE start_time[:10] BETWEEN p.first AND p.last),
           r AS (SELECT *, row_number() OVER (PARTITION BY period, measure ORDER BY length) AS rn,
                        count(*) OVER (PARTITION BY period, measure) AS n FROM l)
           SELECT period, measure, permille, n, length FROM r, (VALUES {asked}) a(permille)
           WHERE rn = greatest((n * permille + 999) // 1000, 1)"""
    )
    # Sketches count exactly below 65,536 distinct values and estimate beyond; this is the exact count at any size.
    sql["distinct_by_period"] = (
        base
        + ", "
        + _ADS.format(blacklist_threshold=threshold).replace("ev AS", "ad_ev AS").replace("FROM ev ", "FROM ad_ev ").strip()
        + f""", seen AS (
             SELECT DISTINCT 'session_id' AS counted, date, session_id AS v FROM actions
             UNION ALL SELECT DISTINCT 'user_id', date, CAST(user_id AS VARCHAR) FROM actions
             UNION ALL SELECT DISTINCT 'listed', date, CAST(user_id AS VARCHAR) FROM user_ad WHERE click_count > {threshold}),
           sides AS (SELECT counted, v, bool_or({early}) AS a, bool_or({late}) AS b FROM seen GROUP BY counted, v)
           SELECT counted, count(*) FILTER (a) AS early, count(*) FILTER (b) AS late, count(*) FILTER (a OR b) AS both_sets,
                  count(*) FILTER (a AND NOT b) AS gone, count(*) FILTER (b AND NOT a) AS added FROM sides GROUP BY counted"""
    )
    sql["visits_of_busy_days"] = (
        base
        + """, d AS (SELECT date, count(*) AS n FROM actions GROUP BY date)
           SELECT date, page_id, count(*) AS visits FROM actions
           WHERE date IN (SELECT date FROM d WHERE n > (SELECT avg(n) FROM d)) GROUP BY date, page_id"""
    )
    sql["visits_by_profile"] = (
        base
        + """SELECT professional, sex, city, count(*) AS visits, count(*) FILTER (click_category_id <> -1) AS clicks,
                    count(pay_category_ids) AS purchases
             FROM actions a JOIN user_info u ON a.user_id = u.user_id GROUP BY professional, sex, city"""
    )
    return sql
