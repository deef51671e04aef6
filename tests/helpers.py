"""Small hand-written logs."""

from datetime import datetime, timedelta

ACTION_SCHEMA = (
    "date string, user_id bigint, session_id string, page_id bigint, action_time timestamp_ntz, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, order_category_ids string, "
    "order_product_ids string, pay_category_ids string, pay_product_ids string, city_id bigint, action_id bigint"
)
_NAMES = [part.split()[0] for part in ACTION_SCHEMA.split(", ")]
START = datetime(2024, 1, 1, 8)


def actions(spark, rows):
    """A log from dicts; ``at`` is seconds after 8 o'clock, ids count up when not given."""
    full = []
    for number, row in enumerate(rows):
        row = {"user_id": 1, "session_id": "s", "page_id": 1, "at": number, "city_id": 0, "action_id": number, **row}
        time = row.pop("at")
        row["action_time"] = None if time is None else START + timedelta(seconds=time)
        row.setdefault("date", "2024-01-01")
        full.append(tuple(row.get(name) for name in _NAMES))
    return spark.createDataFrame(full, ACTION_SCHEMA)


def users(spark, *rows):
    schema = "user_id bigint, username string, name string, age int, professional string, city string, sex string"
    return spark.createDataFrame([(u, f"u{u}", f"n{u}", age, job, city, sex) for u, age, job, city, sex in rows], schema)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, str(v)) for v in row])
