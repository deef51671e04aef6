"""SQL with the results that the registered queries must have, for DuckDB over the test tables."""

from __future__ import annotations

# The views over the test tables, and the steps that several results share. Each query
# below names the last step it needs.
_VIEWS = """
WITH events_k AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events
),
every_action AS (
  SELECT
    strftime(ts, '%Y-%m-%d') AS date,
    user_id,
    user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
    k % 10 AS page_id,
    date_trunc('day', ts)::TIMESTAMP
      + to_hours(CAST(user_id % 24 AS INTEGER))
      + to_seconds(CAST((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 40 AS INTEGER)) AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN k END AS click_product_id,
    CASE WHEN event_type = 'signup' THEN (k % 20) || ',' || ((k + 7) % 20) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
    event_id % 25 AS city_id,
    event_id AS action_id
  FROM events_k
),
action AS (SELECT * FROM every_action WHERE date BETWEEN '2024-01-01' AND '2024-01-30'),
part_action AS (SELECT * FROM action WHERE date BETWEEN '2024-01-05' AND '2024-01-20'),
timed AS (
  SELECT action_id, session_id, min(action_time) OVER (PARTITION BY session_id) AS start_time, action_time
  FROM (
    SELECT action_id, session_id, CASE WHEN action_id % 97 != 0 THEN action_time END AS action_time FROM every_action
  )
),
user_info AS (
  SELECT
    c_custkey AS user_id,
    CAST(c_custkey % 60 AS INTEGER) AS age,
    'professional' || (c_custkey % 100) AS professional,
    'city' || ((c_custkey * 7) % 100) AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_partkey % 2 AS status FROM part
),
city_info AS (
  SELECT
    CAST(n_nationkey AS BIGINT) AS city_id,
    n_name AS city_name,
    CASE r_name
      WHEN 'AFRICA' THEN '华北' WHEN 'AMERICA' THEN '华南' WHEN 'ASIA' THEN '西北'
      WHEN 'EUROPE' THEN '华东' WHEN 'MIDDLE EAST' THEN '东北'
    END AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
session AS (
  SELECT
    session_id,
    arg_min(user_id, (action_time, action_id)) AS user_id,
    coalesce(string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword), '') AS search_keywords,
    coalesce(array_to_string(list_sort(list_distinct(list(click_category_id))), ','), '') AS click_category_ids,
    date_sub('second', min(action_time), max(action_time)) AS visit_length,
    count(*) AS step_length,
    min(action_time) AS start_time
  FROM action
  GROUP BY session_id
),
full_session AS (
  SELECT session.*, age, professional, city, sex FROM session JOIN user_info USING (user_id)
),
matching AS (SELECT * FROM full_session WHERE age BETWEEN 10 AND 50),
detail AS (SELECT * FROM action WHERE session_id IN (SELECT session_id FROM matching)),
hour_count AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS sessions
  FROM matching
  GROUP BY ALL
),
quota AS (
  SELECT
    date, hour, sessions, day_sessions,
    least(sessions, sessions * (900 // (SELECT count(DISTINCT date) FROM hour_count)) // day_sessions) AS quota
  FROM (SELECT *, CAST(sum(sessions) OVER (PARTITION BY date) AS BIGINT) AS day_sessions FROM hour_count)
),
sample AS (
  SELECT session_id, start_time, search_keywords, click_category_ids
  FROM (
    SELECT matching.*, quota,
      row_number() OVER (PARTITION BY date, hour ORDER BY md5(session_id || '42'), session_id) AS position
    FROM matching JOIN quota
      ON quota.date = strftime(start_time, '%Y-%m-%d') AND quota.hour = hour(start_time)
  )
  WHERE position <= quota
),
ordered AS (
  SELECT session_id, try_cast(unnest(string_split(order_category_ids, ',')) AS BIGINT) AS category_id FROM detail
),
paid AS (
  SELECT session_id, try_cast(unnest(string_split(pay_category_ids, ',')) AS BIGINT) AS category_id FROM detail
),
click_n AS (
  SELECT click_category_id AS category_id, count(*) AS n FROM detail WHERE click_category_id IS NOT NULL GROUP BY 1
),
order_n AS (SELECT category_id, count(*) AS n FROM ordered WHERE category_id IS NOT NULL GROUP BY 1),
pay_n AS (SELECT category_id, count(*) AS n FROM paid WHERE category_id IS NOT NULL GROUP BY 1),
category AS (
  SELECT category_id FROM click_n UNION SELECT category_id FROM order_n UNION SELECT category_id FROM pay_n
),
category_n AS (
  SELECT
    category_id,
    coalesce(click_n.n, 0) AS click_count,
    coalesce(order_n.n, 0) AS order_count,
    coalesce(pay_n.n, 0) AS pay_count
  FROM category
  LEFT JOIN click_n USING (category_id)
  LEFT JOIN order_n USING (category_id)
  LEFT JOIN pay_n USING (category_id)
),
top_category AS (
  SELECT * FROM category_n ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
session_click AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM detail WHERE click_category_id IS NOT NULL
  GROUP BY ALL
),
top_click AS (SELECT * FROM session_click WHERE category_id IN (SELECT category_id FROM top_category)),
top_session AS (
  SELECT category_id, session_id, click_count FROM top_click
  QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10
),
page_pair AS (
  SELECT lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS prev_page, page_id FROM action
),
step AS (
  SELECT * FROM (VALUES (1, '1_2'), (2, '2_3'), (3, '3_4'), (4, '4_5')) AS t(step, split)
),
split_n AS (
  SELECT prev_page || '_' || page_id AS split, count(*) AS pv FROM page_pair
  WHERE prev_page || '_' || page_id IN (SELECT split FROM step)
  GROUP BY 1
),
rate AS (
  SELECT step, split, pv, prev_pv, ((200 * pv + prev_pv) // nullif(2 * prev_pv, 0)) / CAST(100 AS DOUBLE) AS rate
  FROM (
    SELECT step, split, coalesce(pv, 0) AS pv,
      coalesce(lag(coalesce(pv, 0)) OVER (ORDER BY step), (SELECT count(*) FROM action WHERE page_id = 1)) AS prev_pv
    FROM step LEFT JOIN split_n USING (split)
  )
),
click AS (
  SELECT city_id, click_product_id AS product_id FROM action WHERE click_product_id IS NOT NULL
),
basic AS (SELECT city_id, city_name, area, product_id FROM click JOIN city_info USING (city_id)),
area_click AS (
  SELECT area, product_id, count(*) AS click_count,
    string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name) AS city_infos
  FROM basic
  GROUP BY ALL
),
full_click AS (
  SELECT area_click.*, product_name, CASE WHEN status = 0 THEN '自营' ELSE '第三方' END AS product_status
  FROM area_click JOIN product_info USING (product_id)
),
area_level AS (
  SELECT area,
    CASE
      WHEN area IN ('华北', '华东') THEN 'A级'
      WHEN area IN ('华南', '华中') THEN 'B级'
      WHEN area IN ('西北', '西南') THEN 'C级'
      ELSE 'D级'
    END AS area_level
  FROM (SELECT DISTINCT area FROM city_info)
)
"""

_DETAIL = """user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
  order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, action_id"""

_VISIT = {
    "1s_3s": "visit_length BETWEEN 1 AND 3",
    "4s_6s": "visit_length BETWEEN 4 AND 6",
    "7s_9s": "visit_length BETWEEN 7 AND 9",
    "10s_30s": "visit_length BETWEEN 10 AND 30",
    "30s_60s": "visit_length > 30 AND visit_length <= 60",
    "1m_3m": "visit_length > 60 AND visit_length <= 180",
    "3m_10m": "visit_length > 180 AND visit_length <= 600",
    "10m_30m": "visit_length > 600 AND visit_length <= 1800",
    "30m": "visit_length > 1800",
}
_STEP = {
    "1_3": "step_length BETWEEN 1 AND 3",
    "4_6": "step_length BETWEEN 4 AND 6",
    "7_9": "step_length BETWEEN 7 AND 9",
    "10_30": "step_length BETWEEN 10 AND 30",
    "30_60": "step_length > 30 AND step_length <= 60",
    "60": "step_length > 60",
}


def _histogram(buckets: dict[str, str]) -> str:
    rows = [f"SELECT '{name}' AS bucket, count(*) AS sessions FROM matching WHERE {test}" for name, test in buckets.items()]
    return " UNION ALL ".join(rows)


def _shares() -> str:
    named = {f"visit_length_{name}_ratio": test for name, test in _VISIT.items()}
    named |= {f"step_length_{name}_ratio": test for name, test in _STEP.items()}
    return ", ".join(
        f"((200 * count(*) FILTER ({test}) + count(*)) // (2 * count(*))) / CAST(100 AS DOUBLE) AS {name}"
        for name, test in named.items()
    )


_RESULTS = {
    "action_date_range": f"SELECT date, {_DETAIL}, city_id FROM part_action",
    "click_city_product": """
      SELECT city_id, click_product_id AS product_id FROM part_action WHERE click_product_id IS NOT NULL""",
    "task_params": """
      SELECT
        c_custkey AS task_id,
        strftime(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER), '%Y-%m-%d') AS start_date,
        '2024-01-30' AS end_date,
        CASE WHEN c_custkey % 3 != 0 THEN CAST(c_custkey % 30 AS INTEGER) END AS start_age,
        CASE WHEN c_custkey % 5 != 0 THEN CAST(c_custkey % 30 + 20 AS INTEGER) END AS end_age,
        '1,2,' || (c_custkey % 10) AS target_page_flow
      FROM customer""",
    "session_aggregate": "SELECT * FROM session",
    "session_full_info": "SELECT * FROM full_session",
    "skew_join_sessions": "SELECT * FROM full_session",
    "filter_age_range": "SELECT * FROM full_session WHERE age >= 10 AND age <= 50",
    "filter_in_list": """
      SELECT * FROM full_session WHERE professional IN (
        'professional1', 'professional2', 'professional3', 'professional5', 'professional8', 'professional13',
        'professional21', 'professional34', 'professional55', 'professional89')""",
    "filter_list_overlap": """
      SELECT * FROM full_session WHERE session_id IN (
        SELECT session_id FROM action WHERE search_keyword IN ('kw1', 'kw4', 'kw7'))""",
    "filter_equal": "SELECT * FROM full_session WHERE sex = 'male'",
    "filter_all": """
      SELECT * FROM full_session
      WHERE age BETWEEN 5 AND 55 AND sex = 'male'
        AND CAST(substr(professional, 13) AS INTEGER) < 80 AND CAST(substr(city, 5) AS INTEGER) >= 10
        AND session_id IN (SELECT session_id FROM action WHERE search_keyword IN ('kw1', 'kw2', 'kw4', 'kw6', 'kw8'))
        AND session_id IN (SELECT session_id FROM action WHERE click_category_id IN (1, 3, 5, 7, 9, 11, 13))""",
    "filtered_sessions": "SELECT * FROM matching",
    "session_detail": f"SELECT {_DETAIL} FROM detail",
    "visit_length_histogram": _histogram(_VISIT),
    "step_length_histogram": _histogram(_STEP),
    "session_aggr_stat": f"SELECT count(*) AS session_count, {_shares()} FROM matching",
    "session_hour_counts": "SELECT * FROM hour_count",
    "session_sample_quota": "SELECT * FROM quota",
    "session_sample_large": """
      SELECT session_id
      FROM (
        SELECT session_id, sessions, day_sessions,
          row_number() OVER (PARTITION BY date, hour ORDER BY md5(session_id || '42'), session_id) AS position
        FROM matching JOIN quota
          ON quota.date = strftime(start_time, '%Y-%m-%d') AND quota.hour = hour(start_time)
      )
      WHERE position <= least(
        sessions, sessions * (6000 // (SELECT count(DISTINCT date) FROM hour_count)) // day_sessions)""",
    "session_sample": "SELECT * FROM sample",
    "sample_session_detail": f"SELECT {_DETAIL} FROM action WHERE session_id IN (SELECT session_id FROM sample)",
    "category_ids_distinct": "SELECT category_id FROM category",
    "category_click_count": "SELECT * FROM click_n",
    "category_order_count": "SELECT * FROM order_n",
    "category_pay_count": "SELECT * FROM pay_n",
    "salted_category_count": "SELECT * FROM click_n",
    "category_counts_joined": "SELECT * FROM category_n",
    "category_ranking": """
      SELECT *, CAST(row_number() OVER (
        ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id) AS INTEGER) AS rank
      FROM category_n""",
    "top10_category": "SELECT * FROM top_category",
    "session_category_clicks": "SELECT * FROM session_click",
    "top10_category_session_counts": "SELECT * FROM top_click",
    "top10_session": "SELECT * FROM top_session",
    "top10_session_detail": f"SELECT {_DETAIL} FROM action WHERE session_id IN (SELECT session_id FROM top_session)",
    "page_split_pv": "SELECT * FROM split_n",
    "start_page_pv": "SELECT CAST(1 AS BIGINT) AS page_id, count(*) AS pv FROM action WHERE page_id = 1",
    "page_convert_rate": "SELECT * FROM rate",
    "page_convert_rate_text": """
      SELECT string_agg(split || '=' || coalesce(CAST(rate AS VARCHAR), 'null'), '|' ORDER BY step) AS convert_rate
      FROM rate""",
    "click_product_basic": "SELECT * FROM basic",
    "area_product_clicks": "SELECT * FROM area_click",
    "area_full_product_clicks": "SELECT * FROM full_click",
    "area_top3_products": """
      SELECT area, area_level, product_id, click_count, city_infos, product_name, product_status
      FROM full_click JOIN area_level USING (area)
      QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3""",
    "area_level": "SELECT * FROM area_level",
    "product_status": """
      SELECT product_id, product_name, CASE WHEN status = 0 THEN '自营' ELSE '第三方' END AS product_status
      FROM product_info""",
    "heavy_keys": "SELECT user_id, count(*) AS n FROM every_action GROUP BY user_id ORDER BY n DESC, user_id LIMIT 5",
    "bucketed_session_aggregate": "SELECT * FROM session",
    "bucketed_session_detail": f"SELECT {_DETAIL} FROM detail",
    "bucketed_page_split_pv": "SELECT * FROM split_n",
    "hot_keys": "SELECT user_id, count(*) AS n FROM every_action GROUP BY user_id ORDER BY n DESC, user_id LIMIT 5",
    "date_functions": """
      SELECT
        action_id,
        strftime(action_time, '%Y-%m-%d_%H') AS date_hour,
        strftime(action_time, '%Y-%m-%d %H:%M:%S') AS time_text,
        strftime(action_time, '%Y-%m-%d') AS date_text,
        start_time < action_time AS is_before,
        action_time > start_time + INTERVAL 5 MINUTE AS is_after,
        date_sub('second', start_time, action_time) AS minus_seconds
      FROM every_action JOIN (SELECT session_id, min(action_time) AS start_time FROM every_action GROUP BY 1) USING (session_id)""",
    "date_functions_text": """
      SELECT
        action_id,
        strftime(action_time, '%Y-%m-%d_%H') AS date_hour,
        strftime(action_time, '%Y-%m-%d %H:%M:%S') AS time_text,
        strftime(action_time, '%Y-%m-%d') AS date_text,
        coalesce(start_time < action_time, false) AS is_before,
        coalesce(action_time > start_time + INTERVAL 5 MINUTE, false) AS is_after,
        coalesce(date_sub('second', start_time, action_time), 0) AS minus_seconds
      FROM timed""",
    "string_functions": """
      SELECT
        action_id,
        search_keyword IS NULL OR search_keyword = '' AS is_empty,
        coalesce(order_category_ids, '') || ',' AS trimmed,
        CASE WHEN hour(action_time) < 10 THEN '0' ELSE '' END || hour(action_time) AS padded
      FROM every_action""",
    "concat_field_get": "SELECT session_id, nullif(search_keywords, '') AS value FROM session",
    "concat_field_set": """
      SELECT
        session_id,
        'sessionid=' || session_id || '|searchKeyWords=' || search_keywords || '|clickCategoryIds='
          || click_category_ids || '|visitLength=0|stepLength=' || step_length AS value
      FROM session""",
    "round_half_up": """
      SELECT click_category_id AS category_id,
        ((200 * count(*) + (SELECT count(click_category_id) FROM every_action))
          // (2 * (SELECT count(click_category_id) FROM every_action))) / CAST(100 AS DOUBLE) AS share
      FROM every_action WHERE click_category_id IS NOT NULL
      GROUP BY 1""",
    "round_half_up_value": """
      SELECT product_id, CAST((product_id * 125 + 5) // 10 AS DOUBLE) / 100 AS value FROM product_info""",
    "sql_functions": """
      SELECT product_id, product_id || ':' || product_name AS info, CAST(status AS VARCHAR) AS status FROM product_info""",
    "concat_long_string": "SELECT city_id, city_id || ':' || city_name AS city_info FROM city_info",
    "group_concat_distinct": """
      SELECT area,
        string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name) AS city_infos
      FROM city_info
      GROUP BY area""",
    "json_field": "SELECT product_id, CAST(status AS VARCHAR) AS value FROM product_info",
}


# Result table -> the query it holds; column names and order are those of the table.
_TABLES = {
    "session_aggr_stat": "session_aggr_stat",
    "session_random_extract": "session_sample",
    "session_detail": "sample_session_detail",
    "top10_category": "top10_category",
    "top10_session": "top10_session",
    "top10_session_detail": "top10_session_detail",
    "page_split_convert_rate": "page_convert_rate_text",
    "area_top3_product": "area_top3_products",
}
_RESULTS |= {
    f"result_{table}": f"SELECT CAST(7 AS BIGINT) AS task_id, {'* EXCLUDE (action_id)' if 'detail' in table else '*'} FROM ({_RESULTS[name]})"
    for table, name in _TABLES.items()
}


def oracle_sql() -> dict[str, str]:
    return {name: _VIEWS + result for name, result in _RESULTS.items()}
