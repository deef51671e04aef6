import pytest
from helpers import ACTION_SCHEMA, actions, rows

from footfall.operators import page_flow, sessions
from footfall.schemas import CITY_INFO, RESULT_COLUMNS, USER_VISIT_ACTION
from footfall.sources import layout, tables
from footfall.sources.results import JdbcResults, ParquetResults, result_rows


def test_actions_from_text_times(spark, tmp_path):
    log = spark.createDataFrame(
        [("2024-01-01", "1", "s", "2024-01-01 9:05:03"), ("2024-01-01", "2", "s", "later")],
        "date string, user_id string, session_id string, action_time string",
    )
    rest = [field.name for field in USER_VISIT_ACTION if field.name not in log.columns]
    full = log.selectExpr("*", *[f"CAST(NULL AS STRING) AS {name}" for name in rest])
    full.write.parquet(f"{tmp_path}/log")
    read = tables.read_actions(spark, f"{tmp_path}/log")
    assert read.schema == USER_VISIT_ACTION
    assert sorted(str(row.action_time) for row in read.collect()) == ["2024-01-01 09:05:03", "None"]
    read.createOrReplaceTempView("log_view")
    assert tables.read_actions(spark, "log_view").count() == 2
    full.drop("page_id").createOrReplaceTempView("short_view")
    with pytest.raises(ValueError, match="page_id"):
        tables.read_actions(spark, "short_view")


def test_row_ids_are_kept(spark):
    actions(spark, [{}]).createOrReplaceTempView("with_ids")
    assert tables.read_actions(spark, "with_ids").columns[-1] == "action_id"


def test_date_range_reads_only_its_folders(spark, tmp_path):
    log = actions(spark, [{"date": f"2024-01-{day:02}"} for day in range(1, 11)])
    log.write.partitionBy("date").parquet(f"{tmp_path}/log")
    read = spark.read.schema(ACTION_SCHEMA).parquet(f"{tmp_path}/log")
    picked = tables.action_date_range(read, "2024-01-03", "2024-01-05")
    assert sorted(row.date for row in picked.select("date").collect()) == ["2024-01-03", "2024-01-04", "2024-01-05"]
    assert len(picked.inputFiles()) == 10
    plan = picked.select("page_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "ReadSchema: struct<page_id:bigint>" in plan
    with pytest.raises(ValueError):
        tables.action_date_range(read, None, "2024-01-05")


def test_date_range_is_pushed_to_an_unpartitioned_scan(spark, tmp_path):
    actions(spark, [{}]).write.parquet(f"{tmp_path}/log")
    picked = tables.action_date_range(spark.read.parquet(f"{tmp_path}/log"), "2024-01-03", "2024-01-05")
    plan = picked.select("page_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-03), LessThanOrEqual(date,2024-01-05)" in plan
    assert "ReadSchema: struct<date:string,page_id:bigint>" in plan


def test_city_table_with_other_id_type(spark):
    cities = spark.createDataFrame([("7", "x", "y", 1)], "city_id string, city_name string, area string, more int")
    assert tables.city_info(cities).schema == CITY_INFO
    assert rows(tables.city_info(cities)) == [(7, "x", "y")]


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "city_info", "me", None, fetchsize=10) == {
        "url": "jdbc:x",
        "dbtable": "city_info",
        "user": "me",
        "fetchsize": "10",
    }
    assert tables.jdbc_split_options("city_id", 0, 100, 4) == {
        "partitionColumn": "city_id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        tables.jdbc_split_options("city_id", 0, 100, 0)
    sink = JdbcResults(tables.jdbc_options("jdbc:x", "any", "me"))
    assert sink.options == {"url": "jdbc:x", "user": "me", "batchsize": "1000", "numPartitions": "10"}


def test_result_rows(spark):
    df = spark.createDataFrame([(4, "s", 1, "more")], "click_count long, session_id string, category_id long, x string")
    made = result_rows(df, "top10_session", 7)
    assert made.columns == ["task_id", *RESULT_COLUMNS["top10_session"]]
    assert rows(made) == [(7, 1, "s", 4)]
    with pytest.raises(ValueError, match="order_count"):
        result_rows(df, "top10_category", 7)
    with pytest.raises(ValueError, match="nothing"):
        result_rows(df, "nothing", 7)


def test_writing_a_task_again_replaces_its_rows(spark, tmp_path):
    results = ParquetResults(f"{tmp_path}/results/")
    rates = spark.createDataFrame([("1_2=0.5",)], "convert_rate string")
    results.write(rates, "page_split_convert_rate", 1)
    results.write(rates, "page_split_convert_rate", 2)
    results.write(rates, "page_split_convert_rate", 2)
    results.write(rates.limit(0), "page_split_convert_rate", 1)
    table = spark.read.parquet(f"{tmp_path}/results/page_split_convert_rate")
    assert [(row.convert_rate, row.task_id) for row in table.collect()] == [("1_2=0.5", 2)]


def test_a_rerun_that_fails_leaves_the_result_of_the_run_before(spark, tmp_path):
    results = ParquetResults(f"{tmp_path}/results")
    rates = spark.createDataFrame([("1_2=0.5",), ("2_3=0.1",)], "convert_rate string")
    for task_id in (1, 2):
        results.write(rates, "page_split_convert_rate", task_id)
    bad = spark.range(4).selectExpr("IF(id = 3, raise_error('lost'), CAST(id AS STRING)) AS convert_rate")
    with pytest.raises(Exception, match="lost"):
        results.write(bad, "page_split_convert_rate", 1)
    table = spark.read.parquet(f"{tmp_path}/results/page_split_convert_rate")
    assert rows(table) == [("1_2=0.5", 1), ("1_2=0.5", 2), ("2_3=0.1", 1), ("2_3=0.1", 2)]
    results.write(rates.limit(1), "page_split_convert_rate", 1)
    table = spark.read.parquet(f"{tmp_path}/results/page_split_convert_rate")
    assert rows(table) == [("1_2=0.5", 1), ("1_2=0.5", 2), ("2_3=0.1", 2)]


def test_an_empty_result_that_is_found_so_late_replaces_too(spark, tmp_path):
    results = ParquetResults(f"{tmp_path}/results")
    rates = spark.range(100).selectExpr("CAST(id % 7 AS STRING) AS convert_rate")
    results.write(rates, "page_split_convert_rate", 3)
    none = rates.groupBy("convert_rate").count().where("count > 1000").select("convert_rate")
    results.write(none, "page_split_convert_rate", 3)
    assert spark.read.parquet(f"{tmp_path}/results/page_split_convert_rate").count() == 0


def test_a_log_by_session_is_read_without_a_shuffle(spark):
    log = actions(spark, [{"session_id": s, "page_id": n % 5, "at": at} for n, (s, at) in enumerate(LOG)])
    layout.write_by_session(log, "log_by_session", 4)
    try:
        kept = layout.read_by_session(spark, "log_by_session")
        assert rows(kept) == rows(log)
        plain = sessions.render_lists(sessions.aggregate_sessions(log))
        aggregated = sessions.aggregate_sessions(kept)
        assert rows(sessions.render_lists(aggregated)) == rows(plain)
        long = aggregated.where("step_length > 2")
        joined = sessions.join_in_buckets(kept, long.select("session_id", "start_time"))
        wanted = sessions.join_sessions(log, plain.where("step_length > 2").select("session_id", "start_time"))
        assert rows(joined) == rows(wanted) and joined.where("session_id IS NULL").count() > 2
        semi = sessions.join_in_buckets(kept, long.select("session_id"), "left_semi")
        assert rows(semi) == rows(wanted.drop("start_time"))
        steps = page_flow.steps_in_buckets(kept)
        assert rows(steps) == rows(page_flow.page_steps(log))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (aggregated, joined, semi, steps):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(session_id" not in plan and "hashpartitioning(coalesce(session_id" not in plan
            assert "Bucketed: true" in plan
        # One small exchange may be left: it checks that the NULL session is one row.
        for df in (aggregated, steps):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        spark.sql("DROP TABLE log_by_session")


LOG = [(f"s{n % 9}" if n % 4 else None, (n * 7) % 30) for n in range(80)] + [("late", None)]
