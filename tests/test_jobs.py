"""The three jobs over the test tables, written to Parquet and compared with the queries."""

import json

import pytest
from helpers import rows
from pyspark import StorageLevel
from pyspark.sql import functions as F

from footfall.__main__ import parser, run
from footfall.operators import sessions
from footfall.plans import jobs, queries
from footfall.plans.staging import counted, staged
from footfall.schemas import RESULT_COLUMNS, TASK
from footfall.sources import fixtures
from footfall.sources.results import ParquetResults

SF_DIR = "/root/testdata/sf0.001"
PARAM = {
    "startDate": ["2024-01-01"],
    "endDate": ["2024-01-30"],
    "startage": ["10"],
    "endage": ["50"],
    "targetPageFlow": ["1,2,3,4,5"],
}
QUERY_OF = {
    "session_aggr_stat": "session_aggr_stat",
    "session_random_extract": "session_sample",
    "session_detail": "sample_session_detail",
    "top10_category": "top10_category",
    "top10_session": "top10_session",
    "top10_session_detail": "top10_session_detail",
    "page_split_convert_rate": "page_convert_rate_text",
    "area_top3_product": "area_top3_products",
}


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    fixtures.user_visit_action(spark, SF_DIR).write.partitionBy("date").parquet(f"{folder}/actions")
    fixtures.user_info(spark, SF_DIR).write.parquet(f"{folder}/users")
    fixtures.product_info(spark, SF_DIR).createOrReplaceTempView("product_info")
    fixtures.city_info(spark, SF_DIR).createOrReplaceTempView("city_info")
    tasks = [(7, None, None, None, None, None, None, json.dumps(PARAM))]
    spark.createDataFrame(tasks, TASK).createOrReplaceTempView("task")
    for job in ("session", "page-flow", "area"):
        arguments = [job, "--task-id=7", f"--actions={folder}/actions", f"--users={folder}/users", f"--out={folder}/out"]
        arguments += [f"--sample-size={queries.SAMPLE_SIZE}", f"--seed={queries.SAMPLE_SEED}"]
        run(spark, parser().parse_args(arguments))
    return f"{folder}/out"


@pytest.mark.parametrize("table", QUERY_OF)
def test_result_table(spark, out, table):
    written = spark.read.parquet(f"{out}/{table}")
    assert written.columns == [*RESULT_COLUMNS[table], "task_id"]
    assert {row.task_id for row in written.select("task_id").collect()} == {7}
    expected = queries.queries()[QUERY_OF[table]](spark, SF_DIR).select(*RESULT_COLUMNS[table])
    assert rows(written.drop("task_id")) == rows(expected)
    assert expected.count() > 0


def test_an_output_is_needed(spark):
    with pytest.raises(ValueError, match="--out"):
        run(spark, parser().parse_args(["area", "--task-id=7"]))


def test_a_missing_task_is_an_error(spark, out, tmp_path):
    with pytest.raises(LookupError):
        run(spark, parser().parse_args(["area", "--task-id=8", f"--out={tmp_path}"]))


def test_staging_writes_to_the_shared_folder(spark):
    df = spark.range(5).selectExpr("id", "rand() AS r")
    with staged(df) as kept:
        assert rows(kept) == rows(kept)
        assert "ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()


def test_staging_without_a_folder_keeps_rows_on_the_executors(spark, monkeypatch):
    class Unset:
        def get(self, name, default=None):
            return default

    df = spark.range(5).selectExpr("id", "rand() AS r")
    monkeypatch.setitem(vars(df.sparkSession), "conf", Unset())
    assert df.sparkSession.conf.get("spark.checkpoint.dir") is None
    with staged(df) as kept:
        assert kept.storageLevel == StorageLevel.MEMORY_AND_DISK
        assert rows(kept) == rows(kept)
    assert not kept.storageLevel.useDisk


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    names = ["session_sample", "top10_session", "page_convert_rate", "area_top3_products"]
    build = queries.queries()
    first = {name: rows(build[name](spark, SF_DIR)) for name in names}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert {name: rows(build[name](spark, SF_DIR)) for name in names} == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_totals_are_observed_while_rows_are_written(spark, monkeypatch):
    df = spark.range(1000).repartition(5).selectExpr("id", "id % 7 AS visit_length", "id % 9 AS step_length")
    expected = rows(sessions.session_aggr_stat(df))
    with counted(df, sessions.stat_counts()) as (kept, totals):
        assert rows(sessions.stat_of_totals(spark, totals)) == expected
        assert kept.count() == 1000
        assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="(?i)path|file"):
        kept.count()  # deleted with its last reader


def test_totals_without_a_folder_are_counted(spark, monkeypatch):
    real = spark.conf

    class Unset:
        def get(self, name, *default):
            return None if name == "spark.checkpoint.dir" else real.get(name, *default)

    df = spark.range(9).selectExpr("id", "id AS visit_length", "id AS step_length").where("id < 0")
    monkeypatch.setitem(vars(df.sparkSession), "conf", Unset())
    with counted(df, [F.count("*").alias("session_count")]) as (kept, totals):
        assert totals == {"session_count": 0} and kept.count() == 0
    monkeypatch.undo()
    found = sessions.stat_of_totals(spark, totals).first()
    assert found.session_count == 0 and found[1] is None
