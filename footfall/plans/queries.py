"""The registered queries: each takes a session and a folder of test tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import functions as fn
from footfall import params
from footfall.operators import areas, categories, filters, page_flow, sampling, sessions, skew
from footfall.params import TaskParams
from footfall.plans import jobs
from footfall.plans.staging import kept
from footfall.schemas import SESSION_COLUMNS, USER_COLUMNS
from footfall.sources import fixtures, layout, tables
from footfall.sources.results import result_rows

PARAMS = TaskParams(
    start_date="2024-01-01",
    end_date="2024-01-30",
    start_age=10,
    end_age=50,
    target_page_flow="1,2,3,4,5",
)
PROFESSIONALS = [f"professional{n}" for n in (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)]
KEYWORDS = ["kw1", "kw4", "kw7"]
SAMPLE_SIZE, LARGE_SAMPLE_SIZE, SAMPLE_SEED = 900, 6000, 42
HOT_KEYS = 5
SESSIONS_PER_PART = 8
BUCKETS = 8
TASK_ID = 7
# A range that leaves rows out at both ends.
PART_OF_THE_LOG = "2024-01-05", "2024-01-20"
ALL_FILTERS = TaskParams(
    start_age=5,
    end_age=55,
    professionals=[f"professional{n}" for n in range(80)],
    cities=[f"city{n}" for n in range(10, 100)],
    sex="male",
    keywords=["kw1", "kw2", "kw4", "kw6", "kw8"],
    category_ids=[1, 3, 5, 7, 9, 11, 13],
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(build):
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = PARAMS.date_range()
    return tables.action_date_range(fixtures.user_visit_action(spark, sf_dir, *dates), *dates)


def _full_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggregated = sessions.aggregate_sessions(_actions(spark, sf_dir))
    return sessions.join_users(aggregated, fixtures.user_info(spark, sf_dir))


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_sessions(_actions(spark, sf_dir), fixtures.user_info(spark, sf_dir), PARAMS)


def _every_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.user_visit_action(spark, sf_dir)


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.session_category_activity(_actions(spark, sf_dir), _filtered(spark, sf_dir))


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions are aggregated once: for the filter, and for the ids of long ones."""
    actions = _actions(spark, sf_dir)
    flagged = kept(sessions.flagged_sessions(actions, PARAMS).drop("search_keywords", "click_category_ids"))
    matching = sessions.matching_sessions(flagged, fixtures.user_info(spark, sf_dir), PARAMS)
    return sessions.session_detail(actions, matching, sessions.long_sessions(flagged))


# Scans


@_query
def action_date_range(spark, sf_dir):
    actions = tables.action_date_range(fixtures.user_visit_action(spark, sf_dir, *PART_OF_THE_LOG), *PART_OF_THE_LOG)
    return actions.select("date", *sessions.detail_columns(actions), "city_id")


def _clicks(spark, sf_dir):
    return areas.click_city_product(_actions(spark, sf_dir))


@_query
def click_city_product(spark, sf_dir):
    return areas.click_city_product(action_date_range(spark, sf_dir))


@_query
def task_params(spark, sf_dir):
    return params.task_params(fixtures.task(spark, sf_dir)).select(
        "task_id", "start_date", "end_date", "start_age", "end_age", "target_page_flow"
    )


# Sessions


@_query
def session_aggregate(spark, sf_dir):
    return sessions.render_lists(sessions.aggregate_sessions(_actions(spark, sf_dir)))


@_query
def session_full_info(spark, sf_dir):
    return sessions.render_lists(_full_info(spark, sf_dir))


@_query
def skew_join_sessions(spark, sf_dir):
    aggregated = sessions.aggregate_sessions(_actions(spark, sf_dir))
    users = fixtures.user_info(spark, sf_dir).select("user_id", *USER_COLUMNS)
    joined = skew.skew_join(aggregated, users, "user_id", SESSIONS_PER_PART, row_id="session_id")
    return sessions.render_lists(joined.select(*SESSION_COLUMNS, *USER_COLUMNS))


def _filter_query(spark, sf_dir, wanted):
    return sessions.render_lists(filters.filter_sessions(_full_info(spark, sf_dir), wanted))


@_query
def filter_age_range(spark, sf_dir):
    return _filter_query(spark, sf_dir, TaskParams(start_age=10, end_age=50))


@_query
def filter_in_list(spark, sf_dir):
    return _filter_query(spark, sf_dir, TaskParams(professionals=PROFESSIONALS))


@_query
def filter_list_overlap(spark, sf_dir):
    return _filter_query(spark, sf_dir, TaskParams(keywords=KEYWORDS))


@_query
def filter_equal(spark, sf_dir):
    return _filter_query(spark, sf_dir, TaskParams(sex="male"))


@_query
def filter_all(spark, sf_dir):
    """All six filters at once, by flags of the session."""
    found = sessions.filtered_sessions(_actions(spark, sf_dir), fixtures.user_info(spark, sf_dir), ALL_FILTERS)
    return sessions.render_lists(found)


@_query
def filtered_sessions(spark, sf_dir):
    return sessions.render_lists(_filtered(spark, sf_dir))


@_query
def session_detail(spark, sf_dir):
    return _detail(spark, sf_dir)


@_query
def visit_length_histogram(spark, sf_dir):
    return sessions.visit_length_histogram(_filtered(spark, sf_dir))


@_query
def step_length_histogram(spark, sf_dir):
    return sessions.step_length_histogram(_filtered(spark, sf_dir))


@_query
def session_aggr_stat(spark, sf_dir):
    return sessions.session_aggr_stat(_filtered(spark, sf_dir))


# Sampling


@_query
def session_hour_counts(spark, sf_dir):
    return sampling.session_hour_counts(_filtered(spark, sf_dir))


@_query
def session_sample_quota(spark, sf_dir):
    return sampling.session_sample_quota(session_hour_counts(spark, sf_dir), SAMPLE_SIZE)


def _sample(spark, sf_dir):
    return sampling.sample_sessions(_filtered(spark, sf_dir), SAMPLE_SIZE, SAMPLE_SEED)


@_query
def session_sample_large(spark, sf_dir):
    return sampling.sample_sessions(_filtered(spark, sf_dir), LARGE_SAMPLE_SIZE, SAMPLE_SEED)


@_query
def session_sample(spark, sf_dir):
    return sampling.sample_report(sample_session_detail(spark, sf_dir))


@_query
def sample_session_detail(spark, sf_dir):
    return sampling.sampled_detail(_actions(spark, sf_dir), _sample(spark, sf_dir), SAMPLE_SIZE)


# Categories


@_query
def category_ids_distinct(spark, sf_dir):
    return categories.category_ids(_detail(spark, sf_dir))


@_query
def category_click_count(spark, sf_dir):
    return categories.category_click_counts(_detail(spark, sf_dir))


@_query
def category_order_count(spark, sf_dir):
    return categories.category_order_counts(_detail(spark, sf_dir))


@_query
def category_pay_count(spark, sf_dir):
    return categories.category_pay_counts(_detail(spark, sf_dir))


@_query
def salted_category_count(spark, sf_dir):
    clicks = _detail(spark, sf_dir).where("click_category_id IS NOT NULL")
    return skew.salted_count(clicks.select(F.col("click_category_id").alias("category_id")), "category_id")


@_query
def category_counts_joined(spark, sf_dir):
    """The three counts are columns of one count of the log, and are joined by category."""
    counted = kept(categories.category_counts(_detail(spark, sf_dir)))
    names = ("click_count", "order_count", "pay_count")
    counts = [counted.where(F.col(name) > 0).select("category_id", F.col(name).alias("n")) for name in names]
    return categories.join_category_counts(counted.select("category_id"), *counts)


@_query
def category_ranking(spark, sf_dir):
    return categories.rank_categories(categories.category_counts(_detail(spark, sf_dir)), kept)


@_query
def top10_category(spark, sf_dir):
    return categories.top_categories(categories.total_activity(_activity(spark, sf_dir)))


@_query
def session_category_clicks(spark, sf_dir):
    return categories.session_category_clicks(_detail(spark, sf_dir))


@_query
def top10_category_session_counts(spark, sf_dir):
    activity = _activity(spark, sf_dir)
    top = categories.top_categories(categories.total_activity(activity))
    return categories.top_category_session_clicks(categories.clicked(activity), top)


@_query
def top10_session(spark, sf_dir):
    return categories.top_sessions(top10_category_session_counts(spark, sf_dir))


@_query
def top10_session_detail(spark, sf_dir):
    return categories.top_session_detail(_actions(spark, sf_dir), top10_session(spark, sf_dir))


# Page flow


def _steps(spark, sf_dir):
    return page_flow.step_counts(_actions(spark, sf_dir))


@_query
def page_split_pv(spark, sf_dir):
    return page_flow.page_split_views(_steps(spark, sf_dir), PARAMS.page_flow())


@_query
def start_page_pv(spark, sf_dir):
    return page_flow.start_page_views(_actions(spark, sf_dir), PARAMS.page_flow())


@_query
def page_convert_rate(spark, sf_dir):
    return jobs.page_convert_rates(_actions(spark, sf_dir), PARAMS)


@_query
def page_convert_rate_text(spark, sf_dir):
    return page_flow.page_convert_rate_text(page_convert_rate(spark, sf_dir))


# Areas


@_query
def click_product_basic(spark, sf_dir):
    return areas.click_product_basic(_clicks(spark, sf_dir), fixtures.city_info(spark, sf_dir))


@_query
def area_product_clicks(spark, sf_dir):
    return areas.area_product_clicks(_clicks(spark, sf_dir), fixtures.city_info(spark, sf_dir))


@_query
def area_full_product_clicks(spark, sf_dir):
    return areas.area_full_product_clicks(area_product_clicks(spark, sf_dir), fixtures.product_info(spark, sf_dir))


@_query
def area_top3_products(spark, sf_dir):
    return jobs.area_top_products(
        _actions(spark, sf_dir), fixtures.city_info(spark, sf_dir), fixtures.product_info(spark, sf_dir), PARAMS
    )


@_query
def area_level(spark, sf_dir):
    cities = fixtures.city_info(spark, sf_dir)
    return cities.select("area").distinct().select("area", areas.area_level().alias("area_level"))


@_query
def product_status(spark, sf_dir):
    return areas.product_status(fixtures.product_info(spark, sf_dir))


@_query
def hot_keys(spark, sf_dir):
    return skew.hot_keys(_every_action(spark, sf_dir).select("user_id"), "user_id", HOT_KEYS)


@_query
def heavy_keys(spark, sf_dir):
    return skew.heavy_keys(_every_action(spark, sf_dir).select("user_id"), "user_id", HOT_KEYS)


# A log that is bucketed by session


def _bucketed(spark, sf_dir):
    """The actions of all dates as a table of this application, written once."""
    name = "by_session_" + hashlib.md5(f"{spark.sparkContext.applicationId} {sf_dir}".encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        layout.write_by_session(_actions(spark, sf_dir), name, BUCKETS)
    return layout.read_by_session(spark, name)


@_query
def bucketed_session_aggregate(spark, sf_dir):
    return sessions.render_lists(sessions.aggregate_sessions(_bucketed(spark, sf_dir)))


@_query
def bucketed_session_detail(spark, sf_dir):
    actions = _bucketed(spark, sf_dir)
    matching = sessions.filtered_sessions(actions, fixtures.user_info(spark, sf_dir), PARAMS)
    return sessions.join_in_buckets(actions.select(*sessions.detail_columns(actions)), matching.select("session_id"), "left_semi")


@_query
def bucketed_page_split_pv(spark, sf_dir):
    return page_flow.page_split_views(page_flow.steps_in_buckets(_bucketed(spark, sf_dir)), PARAMS.page_flow())


# Scalar functions over the tables


@_query
def date_functions(spark, sf_dir):
    """Each action against the start of its session, joined so that no session is sorted whole."""
    return _date_functions(_every_action(spark, sf_dir).select("session_id", "action_id", "action_time"))


def _date_functions(actions):
    starts = kept(actions.groupBy("session_id").agg(F.min(fn.parse_time("action_time")).alias("start_time"), F.count("*").alias("step_length")))
    later = F.col("start_time") + F.make_dt_interval(mins=F.lit(5))
    joined = sessions.join_sessions(actions, starts.drop("step_length"), long=sessions.long_sessions(starts))
    return joined.select(
        "action_id",
        fn.date_hour("action_time").alias("date_hour"),
        fn.format_time("action_time").alias("time_text"),
        fn.format_date("action_time").alias("date_text"),
        fn.before("start_time", "action_time").alias("is_before"),
        fn.after("action_time", later).alias("is_after"),
        fn.seconds_between("action_time", "start_time").alias("minus_seconds"),
    )


@_query
def date_functions_text(spark, sf_dir):
    """Times as text, with one-digit hours; every 97th is not a time."""
    text = F.concat(F.date_format("action_time", "yyyy-MM-dd "), F.hour("action_time").cast("string"), F.date_format("action_time", ":mm:ss"))
    shown = F.when(F.col("action_id") % 97 == 0, F.lit("soon")).otherwise(text)
    return _date_functions(_every_action(spark, sf_dir).select("session_id", "action_id", shown.alias("action_time")))


@_query
def string_functions(spark, sf_dir):
    return _every_action(spark, sf_dir).select(
        "action_id",
        fn.is_empty("search_keyword").alias("is_empty"),
        fn.trim_comma(F.concat(F.lit(","), F.coalesce("order_category_ids", F.lit("")), F.lit(",,"))).alias("trimmed"),
        fn.pad_two(F.hour("action_time").cast("string")).alias("padded"),
    )


def _session_records(spark, sf_dir):
    rendered = sessions.render_lists(sessions.aggregate_sessions(_every_action(spark, sf_dir)))
    return rendered.select(
        "session_id",
        fn.concat_record(
            sessionid="session_id",
            searchKeyWords="search_keywords",
            clickCategoryIds="click_category_ids",
            visitLength="visit_length",
            stepLength="step_length",
        ).alias("record"),
    )


@_query
def concat_field_get(spark, sf_dir):
    return _session_records(spark, sf_dir).select(
        "session_id", fn.concat_field_get("record", "searchKeyWords").alias("value")
    )


@_query
def concat_field_set(spark, sf_dir):
    changed = fn.concat_field_set("record", "visitLength", F.lit("0"))
    return _session_records(spark, sf_dir).select("session_id", changed.alias("value"))


@_query
def round_half_up(spark, sf_dir):
    """Share of each category in all clicks."""
    actions = _every_action(spark, sf_dir)
    clicks = actions.agg(F.count("click_category_id").alias("total")).scalar()
    counts = categories.category_click_counts(actions).withColumn("total", clicks)
    return counts.select("category_id", fn.ratio("n", "total").alias("share"))


@_query
def round_half_up_value(spark, sf_dir):
    """Eighths of the product id: three places, half of them exactly between two of two places."""
    eighth = F.expr("CAST(product_id AS DECIMAL(12, 0)) * CAST(0.125 AS DECIMAL(4, 3))")
    return fixtures.product_info(spark, sf_dir).select("product_id", fn.round_half_up(eighth).cast("double").alias("value"))


@_query
def sql_functions(spark, sf_dir):
    """The functions as SQL text calls them."""
    fn.register_sql_functions(spark)
    return spark.sql(
        """SELECT product_id, concat_long_string(product_id, product_name, ':') AS info,
             json_field(extend_info, 'product_status') AS status
           FROM {products}""",
        products=fixtures.product_info(spark, sf_dir),
    )


@_query
def concat_long_string(spark, sf_dir):
    cities = fixtures.city_info(spark, sf_dir)
    return cities.select("city_id", fn.concat_long_string("city_id", "city_name").alias("city_info"))


@_query
def group_concat_distinct(spark, sf_dir):
    info = fn.concat_long_string("city_id", "city_name")
    return fixtures.city_info(spark, sf_dir).groupBy("area").agg(fn.group_concat_distinct(info).alias("city_infos"))


@_query
def json_field(spark, sf_dir):
    return fixtures.product_info(spark, sf_dir).select(
        "product_id", fn.json_field("extend_info", "product_status").alias("value")
    )


# Result tables


def _result(table: str, build):
    def result(spark, sf_dir):
        return result_rows(build(spark, sf_dir), table, TASK_ID)

    _QUERIES[f"result_{table}"] = result


_result("session_aggr_stat", session_aggr_stat)
_result("session_random_extract", session_sample)
_result("session_detail", sample_session_detail)
_result("top10_category", top10_category)
_result("top10_session", top10_session)
_result("top10_session_detail", top10_session_detail)
_result("page_split_convert_rate", page_convert_rate_text)
_result("area_top3_product", area_top3_products)
