"""Column layouts of the input and result tables.

Times are TIMESTAMP_NTZ inside the library: a click log holds wall-clock text,
and an NTZ column gives the same result whatever the session time zone.
"""

from pyspark.sql import types as T

_LONG, _TEXT = T.LongType(), T.StringType()


def _schema(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


USER_VISIT_ACTION = _schema(
    ("date", _TEXT),
    ("user_id", _LONG),
    ("session_id", _TEXT),
    ("page_id", _LONG),
    ("action_time", T.TimestampNTZType()),
    ("search_keyword", _TEXT),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _TEXT),
    ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT),
    ("pay_product_ids", _TEXT),
    ("city_id", _LONG),
)

USER_INFO = _schema(
    ("user_id", _LONG),
    ("username", _TEXT),
    ("name", _TEXT),
    ("age", T.IntegerType()),
    ("professional", _TEXT),
    ("city", _TEXT),
    ("sex", _TEXT),
)

PRODUCT_INFO = _schema(
    ("product_id", _LONG),
    ("product_name", _TEXT),
    ("extend_info", _TEXT),
)

CITY_INFO = _schema(("city_id", _LONG), ("city_name", _TEXT), ("area", _TEXT))

TASK = _schema(
    ("task_id", _LONG),
    ("task_name", _TEXT),
    ("create_time", _TEXT),
    ("start_time", _TEXT),
    ("finish_time", _TEXT),
    ("task_type", _TEXT),
    ("task_status", _TEXT),
    ("task_param", _TEXT),
)

# Optional extra column of the action log: a unique row id that settles the
# order of actions with the same time.
ACTION_ID = "action_id"

DETAIL_COLUMNS = [
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
]

SESSION_COLUMNS = [
    "session_id",
    "user_id",
    "search_keywords",
    "click_category_ids",
    "visit_length",
    "step_length",
    "start_time",
]

USER_COLUMNS = ["age", "professional", "city", "sex"]

VISIT_RATIOS = [
    "visit_length_1s_3s_ratio",
    "visit_length_4s_6s_ratio",
    "visit_length_7s_9s_ratio",
    "visit_length_10s_30s_ratio",
    "visit_length_30s_60s_ratio",
    "visit_length_1m_3m_ratio",
    "visit_length_3m_10m_ratio",
    "visit_length_10m_30m_ratio",
    "visit_length_30m_ratio",
]

STEP_RATIOS = [
    "step_length_1_3_ratio",
    "step_length_4_6_ratio",
    "step_length_7_9_ratio",
    "step_length_10_30_ratio",
    "step_length_30_60_ratio",
    "step_length_60_ratio",
]

# Result table -> its columns, after the leading task_id.
RESULT_COLUMNS = {
    "session_aggr_stat": ["session_count", *VISIT_RATIOS, *STEP_RATIOS],
    "session_random_extract": [
        "session_id",
        "start_time",
        "search_keywords",
        "click_category_ids",
    ],
    "session_detail": DETAIL_COLUMNS,
    "top10_category": ["category_id", "click_count", "order_count", "pay_count"],
    "top10_session": ["category_id", "session_id", "click_count"],
    "top10_session_detail": DETAIL_COLUMNS,
    "page_split_convert_rate": ["convert_rate"],
    "area_top3_product": [
        "area",
        "area_level",
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        "product_status",
    ],
}
