"""Physical plans: what reaches the scan, what is broadcast, what stays out of single tasks."""

import re

import pytest
from helpers import actions
from pyspark.sql import functions as F

from footfall.operators import categories, sessions
from footfall.plans import queries
from footfall.sources import tables

SF_DIR = "/root/testdata/sf0.001"
SAMPLES = {"session_sample", "session_sample_large", "sample_session_detail"}
QUOTA = SAMPLES | {"session_sample_quota", "result_session_random_extract", "result_session_detail"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return {name: plan(build(spark, SF_DIR)) for name, build in queries.queries().items()}


def test_no_python_and_no_cross_joins(plans):
    for name, text in plans.items():
        for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


@pytest.mark.parametrize("name", ["top10_session", "area_top3_products"])
def test_groups_are_cut_before_the_shuffle(plans, name):
    assert re.search(r"WindowGroupLimit .*Partial", plans[name])


def test_top_categories_are_taken_without_a_full_sort(plans):
    assert "TakeOrderedAndProject(limit=10" in plans["top10_category"]


def test_dates_reach_the_scan(plans):
    with_dates = [text for name, text in plans.items() if "event_id" in text or "ts#" in text]
    dated = [text for text in with_dates if "GreaterThanOrEqual(ts,2024-01-0" in text and "LessThan(ts,2024-01-" in text]
    # The scalar queries read every action.
    assert len(dated) > 30


def test_dates_reach_the_scan_of_either_type(spark, tmp_path):
    for kind in ("string", "date"):
        path = f"{tmp_path}/{kind}"
        log = actions(spark, [{"date": "2024-01-01"}, {"date": "2024-01-03"}]).withColumn("date", F.col("date").cast(kind))
        log.write.parquet(path)
        found = tables.read_actions(spark, path, "2024-01-02", "2024-01-03")
        assert [row.date for row in found.collect()] == ["2024-01-03"]
        assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date,2024-01-02\)", plan(found))


def test_only_needed_columns_are_read(plans):
    assert "ReadSchema: struct<user_id:bigint>" in plans["hot_keys"]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plans["session_aggr_stat"]


def test_statistics_do_not_build_lists(plans):
    for name in ("session_aggr_stat", "top10_category", "top10_session", "session_hour_counts"):
        assert "collect_set" not in plans[name]


def test_user_filters_run_before_the_join(plans):
    join, scan = plans["filtered_sessions"].split("BroadcastHashJoin", 1)
    assert re.search(r"Filter .*c_custkey#\d+L % 60", scan)
    assert "% 60" not in "\n".join(line for line in join.splitlines() if "Filter" in line)


def test_unpartitioned_windows_see_few_rows(plans):
    """Only the quota (24 rows a day), and the ranking (one number for each range), use one."""
    for name, text in plans.items():
        if "Exchange SinglePartition" in text and "Window" in text.split("Exchange SinglePartition")[0]:
            assert name in QUOTA | {"category_ranking"} or (
                "HashAggregate(keys=[]" in text.split("Exchange SinglePartition")[0]
                or "AS __rows#" in text  # the checked size of a broadcast: a limited number of rows
            )


def test_the_log_is_not_counted_for_long_sessions(plans):
    """The aggregate is kept; the initial plan reads the log only in the two branches of the join."""
    for name in ("session_detail", "date_functions", "category_click_count"):
        initial = plans[name].split("== Initial Plan ==")[-1]
        assert len(re.findall(r"FileScan .*events\.parquet", initial)) <= 2, name
    assert len(re.findall(r"FileScan .*events\.parquet", plans["category_counts_joined"])) == 0


def test_semi_join_with_top_categories_runs_before_clicks_are_counted(spark):
    actions = queries._actions(spark, SF_DIR)
    top = categories.top_categories(categories.category_counts(actions))
    text = plan(categories.top_category_session_clicks(categories.session_category_clicks(actions), top))
    join = text.index("LeftSemi")
    assert text.rindex("HashAggregate(keys=[click_category_id", 0, join) < join
    assert "BroadcastHashJoin" in text[:join] + text[join : join + 10]


def test_order_columns(spark):
    actions = queries._actions(spark, SF_DIR)
    assert sessions.order_columns(actions) == ["action_time", "action_id"]
    assert sessions.order_columns(actions.drop("action_id")) == ["action_time", "page_id"]
