"""The named queries as SQL for DuckDB, over the raw test tables."""

from __future__ import annotations

from visitlens.plans.registry import AD_LIMIT, FILTERS, SEED, TASK, TASK_ID
from visitlens.schemas import STEP_BUCKETS, VISIT_BUCKETS

ACTIONS = """
events_k AS (
  SELECT event_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id // 127 AS blk, event_id % 127 AS pos
  FROM events
),
events_s AS (
  SELECT *,
    CASE WHEN pos < 1 THEN 0 WHEN pos < 3 THEN 1 WHEN pos < 7 THEN 2 WHEN pos < 15 THEN 3
         WHEN pos < 31 THEN 4 WHEN pos < 63 THEN 5 ELSE 6 END AS sub,
    (pos - CASE WHEN pos < 1 THEN 0 WHEN pos < 3 THEN 1 WHEN pos < 7 THEN 3 WHEN pos < 15 THEN 7
                WHEN pos < 31 THEN 15 WHEN pos < 63 THEN 31 ELSE 63 END)
      * CASE blk % 3 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 30 END AS sec
  FROM events_k
),
all_actions AS (
  SELECT
    '2024-01-0' || (1 + blk % 5) AS date,
    CASE WHEN (blk * 7 + sub) % 13 = 12 THEN -1 WHEN (blk * 7 + sub) % 11 = 10 THEN 1000000000 + blk
         ELSE (blk * 7 + sub) % 1201 END AS user_id,
    's' || blk || '_' || sub AS session_id,
    (event_id + k) % 10 AS page_id,
    '2024-01-0' || (1 + blk % 5) || ' '
      || lpad(CAST(8 + (blk // 5) % 4 + sec // 3600 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST((sec % 3600) // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(sec % 60 AS VARCHAR), 2, '0') AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || (k % 20) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS click_product_id,
    CASE WHEN event_type = 'signup'
         THEN k || CASE WHEN k % 4 = 0 THEN ',' || ((k + 1) % 100) ELSE '' END END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
    (blk * 7 + sub) % 10 AS city_id
  FROM events_s
),
actions AS (
  SELECT *, CAST(action_time AS TIMESTAMP) AS ts
  FROM all_actions WHERE date BETWEEN '{start}' AND '{end}'
)""".replace("{start}", TASK.start_date).replace("{end}", TASK.end_date)

USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST((c_custkey * 7) % 60 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

RECORDS = """
records AS (
  SELECT s.*, u.age, u.professional, u.sex, u.city
  FROM (
    SELECT session_id,
      COALESCE(MIN(user_id) FILTER (WHERE user_id <> -1), -1) AS user_id,
      MIN(ts) AS start_ts,
      CAST(epoch(MAX(ts)) - epoch(MIN(ts)) AS BIGINT) AS visit_length,
      COUNT(*) AS step_length,
      COALESCE(list_sort(list(DISTINCT search_keyword)
        FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> '')), []) AS keywords,
      COALESCE(list_sort(list(DISTINCT click_category_id)
        FILTER (WHERE click_category_id <> -1)), []) AS categories
    FROM actions GROUP BY session_id
  ) s JOIN users u ON s.user_id = u.user_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _condition(params) -> str:
    tests = ["TRUE"]
    if params.start_age is not None and params.end_age is not None:
        tests.append(f"age BETWEEN {params.start_age} AND {params.end_age}")
    if params.professionals is not None:
        tests.append(f"professional IN ({_quoted(params.professionals)})")
    if params.cities is not None:
        tests.append(f"city IN ({_quoted(params.cities)})")
    if params.sex is not None:
        tests.append(f"sex = '{params.sex}'")
    if params.keywords is not None:
        tests.append(f"list_has_any(keywords, [{_quoted(params.keywords)}])")
    if params.category_ids is not None:
        ids = ", ".join(f"CAST({value} AS BIGINT)" for value in params.category_ids)
        tests.append(f"list_has_any(categories, [{ids}])")
    return " AND ".join(tests)


PASSED = f"passed AS (SELECT * FROM records WHERE {_condition(TASK)})"

HOURS = """
hours AS (
  SELECT *, SUM(hour_count) OVER (PARTITION BY date) AS date_count,
         (SELECT COUNT(DISTINCT strftime(start_ts, '%Y-%m-%d')) FROM passed) AS n_dates
  FROM (
    SELECT strftime(start_ts, '%Y-%m-%d') AS date, hour(start_ts) AS hour, COUNT(*) AS hour_count
    FROM passed GROUP BY 1, 2
  )
)"""

QUOTAS = """
quotas AS (
  SELECT *, CAST(LEAST(FLOOR(CAST(hour_count AS DOUBLE) / CAST(date_count AS DOUBLE)
                             * (100 // n_dates)), hour_count) AS BIGINT) AS quota
  FROM hours
)"""

DRAWN = f"""
drawn AS (
  SELECT r.* FROM (
    SELECT *, strftime(start_ts, '%Y-%m-%d') AS date, hour(start_ts) AS hour,
      ROW_NUMBER() OVER (PARTITION BY strftime(start_ts, '%Y-%m-%d'), hour(start_ts)
                         ORDER BY md5(session_id || '|{SEED}'), session_id) AS rn
    FROM passed
  ) r JOIN quotas q ON r.date = q.date AND r.hour = q.hour
  WHERE r.rn <= q.quota
)"""

CATEGORY_COUNTS = """
touched AS (
  SELECT session_id, click_category_id AS category_id, 1 AS c, 0 AS o, 0 AS p
  FROM actions WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 0, 1, 0
  FROM actions WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 0, 0, 1
  FROM actions WHERE pay_category_ids IS NOT NULL
),
of_passed AS (
  SELECT * FROM touched WHERE session_id IN (SELECT session_id FROM passed)
),
top_categories AS (
  SELECT category_id, CAST(SUM(c) AS BIGINT) AS c, CAST(SUM(o) AS BIGINT) AS o,
         CAST(SUM(p) AS BIGINT) AS p
  FROM of_passed GROUP BY category_id
  ORDER BY c DESC, o DESC, p DESC, category_id LIMIT 10
)"""

BASE = (ACTIONS, USERS, RECORDS, PASSED)

RECORD_COLUMNS = """
  session_id AS sessionid,
  array_to_string(keywords, ',') AS "searchKeywords",
  array_to_string(categories, ',') AS "clickCategoryIds",
  visit_length AS "visitLength",
  step_length AS "stepLength",
  strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS "startTime",
  age, professional, sex, city"""


def _records(condition: str) -> str:
    return f"{_with(ACTIONS, USERS, RECORDS)} SELECT {RECORD_COLUMNS} FROM records WHERE {condition}"


def _between(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def _histogram(column: str, buckets) -> str:
    cases = " ".join(f"WHEN {_between(column, low, high)} THEN '{name}'" for name, low, high in buckets)
    return f"""{_with(*BASE)}
SELECT bucket, COUNT(*) AS sessions
FROM (SELECT CASE {cases} END AS bucket FROM passed)
WHERE bucket IS NOT NULL GROUP BY bucket"""


def _ratios() -> str:
    """Half-up in whole numbers: DuckDB's ``round`` goes by the binary value."""
    counts, shares = [], []
    for column, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS)):
        for name, low, high in buckets:
            bucket = f"{column}_{name}"
            counts.append(f"COUNT(*) FILTER (WHERE {_between(column, low, high)}) AS {bucket}")
            shares.append(
                f"((200 * {bucket} + GREATEST(n, 1)) // (2 * GREATEST(n, 1))) / 100.0 AS {bucket}_ratio"
            )
    return f"""{_with(*BASE)}, counted AS (SELECT COUNT(*) AS n, {', '.join(counts)} FROM passed)
SELECT '{TASK_ID}' AS taskid, n AS session_count, {', '.join(shares)} FROM counted"""


def _conversion() -> str:
    flow = TASK.target_page_flow
    pairs = ", ".join(f"({a}, {b})" for a, b in zip(flow, flow[1:]))
    return f"""{_with(ACTIONS)}, moves AS (
  SELECT page_id, LEAD(page_id) OVER (PARTITION BY session_id ORDER BY ts, page_id) AS next_page
  FROM actions
),
pairs(a, b) AS (VALUES {pairs}),
counted AS (
  SELECT a, b, COUNT(*) FILTER (WHERE page_id = a) AS n,
         COUNT(*) FILTER (WHERE page_id = a AND next_page = b) AS m
  FROM pairs LEFT JOIN moves ON page_id = a GROUP BY a, b
)
SELECT '{TASK_ID}' AS taskid, a || '_' || b AS page_split,
       ((200 * m + GREATEST(n, 1)) // (2 * GREATEST(n, 1))) / 100.0 AS convert_rate
FROM counted"""


AD_CLICKS = """
SELECT 1704067200000 + event_id * 1000 AS millis, event_id % 10 AS province,
       event_id % 10 AS city, user_id % 100 AS user_id, event_id % 20 AS ad_id
FROM events WHERE event_type <> 'error' AND event_id % 50 NOT IN (7, 11, 13)"""

REJECTED = """
SELECT concat_ws(' ',
         CASE WHEN event_id % 50 = 7 THEN '9223372036854775807'
              ELSE CAST(1704067200000 + event_id * 1000 AS VARCHAR) END,
         CASE WHEN event_id % 50 = 11 THEN 'x' ELSE CAST(event_id % 10 AS VARCHAR) END,
         event_id % 10, user_id % 100,
         CASE WHEN event_type <> 'error' THEN event_id % 20 END,
         CASE WHEN event_type <> 'error' AND event_id % 50 = 13 THEN 1 END) AS value,
       CASE WHEN event_type = 'error' OR event_id % 50 = 13 THEN 'tokens'
            WHEN event_id % 50 = 11 THEN 'number' ELSE 'time' END AS reason
FROM events WHERE event_type = 'error' OR event_id % 50 IN (7, 11, 13)"""


CLICKS_PER_WINDOW = f"""
SELECT millis // 600000 * 600000 AS window_millis, province, city, ad_id, COUNT(*) AS clicks
FROM ({AD_CLICKS}) GROUP BY ALL"""

OVER_LIMIT = f"""
SELECT user_id, ad_id, strftime(make_timestamp(millis * 1000), '%Y-%m-%d') AS day, millis AS reached_millis
FROM ({AD_CLICKS})
QUALIFY row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY millis) = {AD_LIMIT + 1}"""


VISITS = f"""{_with(ACTIONS)},
seconds AS (SELECT user_id, epoch(CAST(action_time AS TIMESTAMP)) AS second FROM all_actions WHERE user_id >= 0),
cut AS (
  SELECT *, coalesce(second - lag(second) OVER (PARTITION BY user_id ORDER BY second) >= 1800, true) AS fresh FROM seconds),
numbered AS (
  SELECT *, count(*) FILTER (WHERE fresh) OVER (PARTITION BY user_id ORDER BY second ROWS UNBOUNDED PRECEDING) AS visit
  FROM cut)
SELECT user_id, visit, CAST(min(second) AS BIGINT) AS first_second, CAST(max(second) AS BIGINT) AS last_second,
       count(*) AS actions
FROM numbered GROUP BY user_id, visit"""


def all_sql() -> dict[str, str]:
    return {
        "actions_in_range": f"{_with(ACTIONS)} SELECT * EXCLUDE (ts) FROM actions",
        "user_profiles": f"{_with(USERS)} SELECT * FROM users",
        "session_full_info": _records("TRUE"),
        **{name: _records(_condition(params)) for name, params in FILTERS.items()},
        "visit_length_histogram": _histogram("visit_length", VISIT_BUCKETS),
        "step_length_histogram": _histogram("step_length", STEP_BUCKETS),
        "session_stat_ratio": _ratios(),
        "sessions_per_hour": f"""{_with(*BASE, HOURS)}
SELECT date, CAST(hour AS INTEGER) AS hour, hour_count, CAST(date_count AS BIGINT) AS date_count,
       CAST(n_dates AS INTEGER) AS n_dates FROM hours""",
        "sample_quota": f"""{_with(*BASE, HOURS, QUOTAS)}
SELECT date, CAST(hour AS INTEGER) AS hour, hour_count, quota FROM quotas""",
        "session_random_extract": f"""{_with(*BASE, HOURS, QUOTAS, DRAWN)}
SELECT '{TASK_ID}' AS taskid, session_id AS sessionid,
       strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS "startTime",
       array_to_string(keywords, ',') AS "searchKeywords",
       array_to_string(categories, ',') AS "clickCategoryIds"
FROM drawn""",
        "session_detail": f"""{_with(*BASE, HOURS, QUOTAS, DRAWN)}
SELECT '{TASK_ID}' AS taskid, user_id AS userid, session_id AS sessionid, page_id AS pageid,
       action_time AS "actionTime", search_keyword AS "searchKeyword",
       click_category_id AS "clickCategoryId", click_product_id AS "clickProductId",
       order_category_ids AS "orderCategoryIds", order_product_ids AS "orderProductIds",
       pay_category_ids AS "payCategoryIds", pay_product_ids AS "payProductIds"
FROM actions WHERE session_id IN (SELECT session_id FROM drawn)""",
        "top10_category": f"""{_with(*BASE, CATEGORY_COUNTS)}
SELECT '{TASK_ID}' AS taskid, category_id AS categoryid, c AS "clickCount",
       o AS "orderCount", p AS "payCount" FROM top_categories""",
        "top10_session": f"""{_with(*BASE, CATEGORY_COUNTS)}
SELECT '{TASK_ID}' AS taskid, category_id AS categoryid, session_id AS sessionid,
       CAST(clicks AS BIGINT) AS "clickCount"
FROM (
  SELECT category_id, session_id, clicks,
         ROW_NUMBER() OVER (PARTITION BY category_id ORDER BY clicks DESC, session_id) AS rn
  FROM (
    SELECT category_id, session_id, SUM(c) AS clicks FROM of_passed
    WHERE c > 0 AND category_id IN (SELECT category_id FROM top_categories)
    GROUP BY category_id, session_id
  )
) WHERE rn <= 10""",
        "page_convert_rate": _conversion(),
        "product_status": """
SELECT p_partkey AS product_id, p_name AS product_name,
       CAST(p_partkey % 2 AS INTEGER) AS product_status FROM part""",
        "time_keys": f"""{_with(ACTIONS)}
SELECT session_id, action_time,
       ts < CAST(date AS TIMESTAMP) + INTERVAL 10 HOUR AS before_ten,
       ts > CAST(date AS TIMESTAMP) + INTERVAL 10 HOUR AS after_ten,
       CAST(epoch(ts) - epoch(CAST(date AS TIMESTAMP)) AS BIGINT) AS second_of_day,
       strftime(ts, '%Y-%m-%d_%H') AS date_hour,
       strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y%m%d') AS date_key,
       strftime(ts, '%Y%m%d%H%M') AS minute_key,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
       strftime(ts, '%Y-%m-%d') AS day_of_key,
       strftime(current_date, '%Y-%m-%d') AS today, 1 AS days_from_yesterday,
       search_keyword IS NULL OR search_keyword = '' AS no_keyword,
       search_keyword IS NOT NULL AND search_keyword <> '' AS has_keyword,
       ((200 * page_id + 8) // 16) / 100.0 AS page_eighths,
       CASE WHEN page_id < 5 THEN ',' ELSE '' END || session_id AS trimmed,
       CASE page_id % 4 WHEN 0 THEN '0'
            WHEN 2 THEN substr(CAST(1000 + page_id * 37 AS VARCHAR), 2, 2)
            ELSE '0' || substr(CAST(1000 + page_id * 37 AS VARCHAR), 2, page_id % 4) END AS two_digits
FROM (SELECT *, CAST(action_time AS TIMESTAMP) AS ts FROM all_actions)""",
        "ad_clicks": AD_CLICKS,
        "ad_click_stream": AD_CLICKS,
        "rejected_ad_lines": REJECTED,
        "unreadable_values": f"""{_with(ACTIONS)}
SELECT COUNT(*) AS actions, COUNT(*) FILTER (WHERE page_id = 3) AS times,
       COUNT(*) FILTER (WHERE page_id < 2 AND order_category_ids IS NOT NULL) AS order_ids,
       CAST(0 AS BIGINT) AS pay_ids
FROM all_actions""",
        "table_round_trip": f"{_with(USERS)} SELECT * FROM users",
        "visits_by_inactivity": VISITS,
        "ad_clicks_per_window": CLICKS_PER_WINDOW,
        "distinct_ad_clicks": f"SELECT DISTINCT * FROM ({AD_CLICKS})",
        "ad_users_over_limit": OVER_LIMIT,
        "ad_users_over_limit_stream": OVER_LIMIT,
    }
