"""The input tables derived from the given test tables.

The test tables have no sessions, pages or categories, so fixed rules derive them from
events (k is the integer in the event's JSON). The rules are part of the test data, not
of the analyses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that the rules read; a given schema saves a job per file to find it.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string",
    "part": "p_partkey bigint, p_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def user_visit_action(
    spark: SparkSession, sf_dir: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """The action log. Given dates are also put on the event time, which the scan can use."""
    events = _read(spark, sf_dir, "events")
    if start_date and end_date:
        first, after_last = F.lit(start_date).cast("date"), F.date_add(F.lit(end_date).cast("date"), 1)
        events = events.where(
            (F.col("ts") >= first.cast("timestamp_ntz")) & (F.col("ts") < after_last.cast("timestamp_ntz"))
        )
    derived = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(ts AS DATE) AS day",
        "(hour(ts) * 3600 + minute(ts) * 60 + CAST(second(ts) AS INT)) div 40 AS seconds",
        """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k""",
    )
    return derived.selectExpr(
        "CAST(day AS STRING) AS date",
        "user_id",
        "concat_ws('-', user_id, replace(CAST(day AS STRING), '-', '')) AS session_id",
        "k % 10 AS page_id",
        "CAST(day AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(user_id % 24 AS INT), 0, seconds) AS action_time",
        "IF(event_type = 'view', concat('kw', k % 10), NULL) AS search_keyword",
        "IF(event_type = 'click', k % 20, NULL) AS click_category_id",
        "IF(event_type = 'click', k, NULL) AS click_product_id",
        "IF(event_type = 'signup', concat_ws(',', k % 20, (k + 7) % 20), NULL) AS order_category_ids",
        "IF(event_type = 'signup', CAST(k AS STRING), NULL) AS order_product_ids",
        "IF(event_type = 'purchase', CAST(k % 20 AS STRING), NULL) AS pay_category_ids",
        "IF(event_type = 'purchase', CAST(k AS STRING), NULL) AS pay_product_ids",
        "event_id % 25 AS city_id",
        "event_id AS action_id",
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "concat('user', c_custkey) AS username",
        "c_name AS name",
        "CAST(c_custkey % 60 AS INT) AS age",
        "concat('professional', c_custkey % 100) AS professional",
        "concat('city', (c_custkey * 7) % 100) AS city",
        "IF(c_custkey % 2 = 0, 'male', 'female') AS sex",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """concat('{"product_status": ', p_partkey % 2, '}') AS extend_info""",
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities; the area that stands for each region is a fixed value."""
    nations = _read(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return nations.join(_read(spark, sf_dir, "region"), "r_regionkey").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS city_id",
        "n_name AS city_name",
        """CASE r_name
             WHEN 'AFRICA' THEN '华北'
             WHEN 'AMERICA' THEN '华南'
             WHEN 'ASIA' THEN '西北'
             WHEN 'EUROPE' THEN '华东'
             WHEN 'MIDDLE EAST' THEN '东北'
           END AS area""",
    )


def task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per customer; every third has an empty start age, every fifth no end age."""
    return _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS task_id",
        "concat('task', c_custkey) AS task_name",
        "'2024-01-01 00:00:00' AS create_time",
        "CAST(NULL AS STRING) AS start_time",
        "CAST(NULL AS STRING) AS finish_time",
        "'session' AS task_type",
        "'new' AS task_status",
        """concat(
             '{"startDate":["', date_add(DATE'2024-01-01', CAST(c_custkey % 28 AS INT)), '"],',
             '"endDate":["2024-01-30"],',
             IF(c_custkey % 3 = 0, '"startage":[],', concat('"startage":["', c_custkey % 30, '"],')),
             IF(c_custkey % 5 = 0, '', concat('"endage":["', c_custkey % 30 + 20, '"],')),
             '"targetPageFlow":["1,2,', c_custkey % 10, '"]}') AS task_param""",
    )
