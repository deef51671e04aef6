import pytest

from footfall.params import TaskParams, load_task, task_params
from footfall.schemas import TASK

SCHEMA = "task_id bigint, task_param string"


def test_first_element_counts_and_gaps_are_null(spark):
    tasks = spark.createDataFrame(
        [
            (1, '{"startDate":["2024-01-01","2024-02-01"],"startage":[],"sex":["male"],"targetPageFlow":["1,2"]}'),
            (2, "not json"),
            (3, None),
            (4, '{"startage":["old"]}'),
        ],
        SCHEMA,
    )
    rows = {row.task_id: row for row in task_params(tasks.where("task_id != 4")).collect()}
    assert (rows[1].start_date, rows[1].start_age, rows[1].sex) == ("2024-01-01", None, "male")
    assert rows[1].target_page_flow == "1,2"
    assert set(rows[2][1:]) == set(rows[3][1:]) == {None}
    with pytest.raises(Exception, match="startage is not a number"):
        load_task(tasks, 4)


def test_load_task(spark):
    text = (
        '{"startDate":["2024-01-01"],"endDate":["2024-01-30"],"startage":["10"],"endage":["50"],'
        '"professionals":["a,b"],"cities":["c"],"sex":["male"],"keyWords":["k1,k2"],"categoryIds":["1,2"],'
        '"targetPageFlow":["1,2,3"]}'
    )
    tasks = spark.createDataFrame([(7, None, None, None, None, None, None, text)], TASK)
    params = load_task(tasks, 7)
    assert params == TaskParams(
        "2024-01-01", "2024-01-30", 10, 50, ["a", "b"], ["c"], "male", ["k1", "k2"], ["1", "2"], [1, 2, 3]
    )
    assert params.date_range() == ("2024-01-01", "2024-01-30")
    assert params.page_flow() == [1, 2, 3]
    with pytest.raises(LookupError):
        load_task(tasks, 8)


@pytest.mark.parametrize("params", [TaskParams(), TaskParams(start_date="2024-01-01"), TaskParams(end_date="2024-01-01")])
def test_a_missing_date_is_an_error(params):
    with pytest.raises(ValueError):
        params.date_range()


def test_empty_lists_are_no_filter():
    assert TaskParams(cities="").cities is None
    assert TaskParams(cities=[]).cities is None
    with pytest.raises(ValueError):
        TaskParams().page_flow()
