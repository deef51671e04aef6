import random

import pytest
from helpers import actions, rows
from pyspark.sql import functions as F

from footfall.operators import page_flow


def brute_steps(log):
    by_session = {}
    for row in log:
        by_session.setdefault(row["session_id"], []).append((row["at"], row["action_id"], row["page_id"]))
    steps = []
    for visits in by_session.values():
        pages = [page for _, _, page in sorted(visits)]
        steps += zip([None, *pages], pages)
    return sorted(steps, key=lambda pair: [(v is None, str(v)) for v in pair])


def random_log(seed, sessions="abc", size=80, times=12):
    random.seed(seed)
    ids = random.sample(range(-500, 500), size)
    return [
        {
            "session_id": random.choice(sessions),
            "page_id": random.randint(0, 4),
            "at": random.randint(0, times),
            "action_id": number,
        }
        for number in ids
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 2, 5, 20, 80])
def test_steps_do_not_depend_on_the_parts(spark, seed, parts):
    log = random_log(seed)
    assert rows(page_flow.page_steps(actions(spark, log), parts)) == brute_steps(log)


@pytest.mark.parametrize("parts", [1, 20])
def test_many_actions_at_one_time(spark, parts):
    log = random_log(5, sessions="aaab", times=1)
    assert rows(page_flow.page_steps(actions(spark, log), parts)) == brute_steps(log)


@pytest.mark.parametrize("parts", [1, 7, 80])
def test_fractions_of_a_second(spark, parts):
    log = random_log(6, sessions="aaab", times=40)
    for row in log:
        row["at"] /= 16
    assert rows(page_flow.page_steps(actions(spark, log), parts)) == brute_steps(log)


UNEVEN = {
    "one time": [{"action_id": 1000 + n, "at": 0} for n in range(2000)],
    "one instant and a few fractions": [{"action_id": n, "at": 0 if n < 1990 else n / 2000} for n in range(2000)],
    "ids with gaps": [{"action_id": n if n < 1990 else n * 10**9, "at": 0} for n in range(2000)],
    "no times": [{"action_id": 1000 + n, "at": None} for n in range(2000)],
    "the NULL session": [{"session_id": None, "action_id": n, "at": n % 3} for n in range(2000)],
}


@pytest.mark.parametrize("name", UNEVEN)
def test_one_session_is_cut_by_count(spark, name):
    """All actions are of one session; no task sorts more than about twice its share of them."""
    log = actions(spark, [{**row, "page_id": n % 7} for n, row in enumerate(UNEVEN[name])])
    ranges = log.repartitionByRange(8, "session_id", "action_time", "action_id").groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in ranges.collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 500
    counted = rows(page_flow.step_counts(log, 8))
    assert counted == rows(page_flow.step_counts(log, 1))
    assert sum(n for _, _, n in counted) == 2000 and [n for before, _, n in counted if before is None] == [1]


def test_a_crowded_instant_without_row_ids(spark):
    log = actions(spark, [{"at": 0, "page_id": n % 3} for n in range(1000)] + [{"at": 1, "page_id": 7}]).drop("action_id")
    expected = [(0, 0, 333), (0, 1, 1), (1, 1, 332), (1, 2, 1), (2, 2, 332), (2, 7, 1), (None, 0, 1)]
    for parts in (1, 3, 8):
        assert rows(page_flow.step_counts(log, parts)) == expected
    assert page_flow.page_steps(log).count() == 1001


def test_the_log_is_read_once(spark, tmp_path):
    actions(spark, random_log(1)).write.parquet(f"{tmp_path}/log")
    counts = page_flow.step_counts(spark.read.parquet(f"{tmp_path}/log"))
    initial = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert initial.count("FileScan") == 1
    assert "rangepartitioning(session_id" in initial and "SinglePartition" not in initial


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_missing_times_and_sessions(spark, parts):
    log = actions(
        spark,
        [
            {"session_id": s, "page_id": page, "at": at}
            for s, page, at in [("a", 1, None), ("a", 2, 3), ("a", 3, 1), (None, 4, 0), (None, 5, 1), ("a", None, 2)]
        ],
    )
    expected = [(1, 3), (3, None), (4, 5), (None, 1), (None, 2), (None, 4)]
    assert rows(page_flow.page_steps(log, parts)) == expected


@pytest.mark.parametrize("parts", [1, 4])
def test_log_without_row_ids(spark, parts):
    log = [{"session_id": "a", "page_id": p, "at": t} for p, t in [(3, 1), (1, 1), (2, 0), (5, 2), (4, 2)]]
    steps = page_flow.page_steps(actions(spark, log).drop("action_id"), parts)
    assert rows(steps) == [(1, 3), (2, 1), (3, 4), (4, 5), (None, 2)]


def session(pages, name="a"):
    return [{"session_id": name, "page_id": page, "at": n} for n, page in enumerate(pages)]


def rates(spark, log, flow):
    steps = page_flow.page_steps(actions(spark, log))
    return page_flow.page_convert_rate(steps, flow)


def test_rates(spark):
    log = session([1, 2, 3, 1, 2, 9, 3, 1], "a") + session([1, 1, 2], "b")
    flow = [1, 2, 3, 4, 5]
    result = rates(spark, log, flow)
    assert [tuple(row) for row in result.orderBy("step").collect()] == [
        (1, "1_2", 3, 5, 0.6),
        (2, "2_3", 1, 3, 0.33),
        (3, "3_4", 0, 1, 0.0),
        (4, "4_5", 0, 0, None),
    ]
    text = page_flow.page_convert_rate_text(result).collect()
    assert [tuple(row) for row in text] == [("1_2=0.6|2_3=0.33|3_4=0.0|4_5=null",)]
    steps = page_flow.page_steps(actions(spark, log))
    assert rows(page_flow.page_split_views(steps, flow)) == [("1_2", 3), ("2_3", 1)]
    assert rows(page_flow.start_page_views(actions(spark, log), flow)) == [(1, 5)]


def test_repeated_split_has_a_row_per_step_and_one_entry_in_the_text(spark):
    result = rates(spark, session([1, 2, 1, 2, 1, 1]), [1, 2, 1, 2])
    assert [tuple(row) for row in result.orderBy("step").collect()] == [
        (1, "1_2", 2, 4, 0.5),
        (2, "2_1", 2, 2, 1.0),
        (3, "1_2", 2, 2, 1.0),
    ]
    assert page_flow.page_convert_rate_text(result).first()[0] == "2_1=1.0|1_2=1.0"


def test_flow_of_one_page_is_empty(spark):
    result = rates(spark, session([1, 2]), [1])
    assert result.collect() == []
    assert page_flow.page_convert_rate_text(result).collect() == []


def test_split_names_are_matched_whole(spark):
    steps = page_flow.page_steps(actions(spark, session([1, 12, 1, 2])))
    assert rows(page_flow.page_split_views(steps, [1, 12, 2])) == [("1_12", 1)]
