import pytest
from helpers import START, actions, rows, users
from pyspark.sql import functions as F

from footfall.operators import categories, filters, page_flow, sessions
from footfall.params import TaskParams


def keep(df, condition):
    return [row[0] for row in (df if condition is None else df.where(condition)).orderBy("id").collect()]


def test_range_needs_both_bounds(spark):
    df = spark.createDataFrame([(1, 9), (2, 10), (3, 50), (4, 51), (5, None)], "id int, age int")
    assert keep(df, filters.in_range("age", 10, 50)) == [2, 3]
    assert keep(df, filters.in_range("age", 10, None)) == [1, 2, 3, 4, 5]
    assert keep(df, filters.in_range("age", None, 50)) == [1, 2, 3, 4, 5]
    assert keep(df, filters.in_range("age", 0, 0)) == []


def test_lists_and_equality(spark):
    df = spark.createDataFrame(
        [(1, "a", ["x", None]), (2, "b", [None]), (3, None, None), (4, "", [])], "id int, v string, l array<string>"
    )
    assert keep(df, filters.in_list("v", ["a", "z"])) == [1]
    assert keep(df, filters.in_list("v", None)) == [1, 2, 3, 4]
    assert keep(df, filters.overlaps_list("l", ["x", "y"])) == [1]
    assert keep(df, filters.overlaps_list("l", ["y"])) == []
    assert keep(df, filters.equals("v", "b")) == [2]
    assert keep(df, filters.equals("v", None)) == [1, 2, 3, 4]
    # A negated filter keeps rows with missing values, so the filters are never NULL.
    assert keep(df, ~filters.in_list("v", ["a"])) == [2, 3, 4]


def test_session_aggregate(spark):
    log = actions(
        spark,
        [
            {"session_id": "a", "user_id": 2, "at": 10, "search_keyword": "phone"},
            {"session_id": "a", "user_id": 1, "at": 3, "click_category_id": 12},
            {"session_id": "a", "user_id": 2, "at": 20, "click_category_id": 1},
            {"session_id": "a", "user_id": 2, "at": 20, "search_keyword": "pho"},
            {"session_id": "a", "user_id": 2, "at": 20, "search_keyword": ""},
            {"session_id": "b", "user_id": 5, "at": 7},
        ],
    )
    result = {row.session_id: row for row in sessions.render_lists(sessions.aggregate_sessions(log)).collect()}
    a, b = result["a"], result["b"]
    assert (a.user_id, a.search_keywords, a.click_category_ids) == (1, "pho,phone", "1,12")
    assert (a.visit_length, a.step_length, (a.start_time - START).seconds) == (17, 5, 3)
    assert (b.user_id, b.search_keywords, b.click_category_ids, b.visit_length, b.step_length) == (5, "", "", 0, 1)


def test_first_user_of_a_tie_is_of_the_smaller_row_id(spark):
    log = actions(spark, [{"user_id": 9, "at": 0, "action_id": 2}, {"user_id": 10, "at": 0, "action_id": 1}])
    assert sessions.aggregate_sessions(log).first().user_id == 10


def test_actions_without_a_time_do_not_name_the_user(spark):
    log = actions(spark, [{"user_id": 9, "at": None}, {"user_id": 10, "at": 5}])
    row = sessions.aggregate_sessions(log).first()
    assert (row.user_id, row.visit_length, row.step_length) == (10, 0, 2)


def test_log_without_row_ids(spark):
    log = actions(spark, [{"user_id": 9, "at": 1}, {"user_id": 10, "at": 0}]).drop("action_id")
    assert sessions.aggregate_sessions(log).first().user_id == 10
    assert "action_id" not in sessions.session_detail(log, log.select("session_id").distinct()).columns


LOG = [
    {"session_id": "a", "user_id": 1, "search_keyword": "k1"},
    {"session_id": "a", "user_id": 1, "click_category_id": 3},
    {"session_id": "b", "user_id": 2, "click_category_id": 30},
    {"session_id": "c", "user_id": 3, "search_keyword": "k11"},
    {"session_id": "d", "user_id": 404},
]


@pytest.mark.parametrize(
    "params, expected",
    [
        (TaskParams(), "abc"),
        (TaskParams(start_age=20, end_age=30), "ab"),
        (TaskParams(professionals="doctor,cook"), "bc"),
        (TaskParams(cities=["rome"]), "ac"),
        (TaskParams(sex="male"), "a"),
        (TaskParams(keywords="k1"), "a"),
        (TaskParams(keywords="k1,k11"), "ac"),
        (TaskParams(category_ids="3"), "a"),
        (TaskParams(category_ids="3,30,x"), "ab"),
        (TaskParams(category_ids="x"), ""),
        (TaskParams(keywords="k1", category_ids="3", sex="male", start_age=0, end_age=99), "a"),
        (TaskParams(keywords="k11", category_ids="3"), ""),
    ],
)
def test_session_filters(spark, params, expected):
    log = actions(spark, LOG)
    people = users(
        spark, (1, 20, "guard", "rome", "male"), (2, 30, "doctor", "oslo", "female"), (3, 31, "cook", "rome", "female")
    )
    flagged = sessions.filtered_sessions(log, people, params)
    on_arrays = filters.filter_sessions(sessions.join_users(sessions.aggregate_sessions(log), people), params)
    assert "".join(sorted(row.session_id for row in flagged.collect())) == expected
    assert flagged.columns == on_arrays.columns
    assert rows(sessions.render_lists(flagged)) == rows(sessions.render_lists(on_arrays))


def test_detail_of_long_sessions_equals_plain_join(spark):
    log = actions(spark, [{"session_id": s, "user_id": n} for n, s in enumerate("abcabacada" * 3)])
    wanted = spark.createDataFrame([("a",), ("c",), ("z",)], "session_id string")
    expected = rows(log.join(wanted, "session_id", "left_semi").select(*sessions.detail_columns(log)))
    sizes = sessions.aggregate_sessions(log)
    for long_session in (0, 3, 8, 100):
        long = sessions.long_sessions(sizes, long_session)
        assert rows(sessions.session_detail(log, wanted, long)) == expected
    assert rows(sessions.session_detail(log, wanted)) == expected
    assert rows(sessions.detail_of_few(log, wanted, 3)) == expected
    assert rows(sessions.detail_of_few(log, wanted, 10**9)) == expected


def test_join_of_long_sessions_equals_plain_join(spark):
    log = actions(spark, [{"session_id": s} for s in "aaaabbc"]).select("session_id", "action_id")
    starts = log.groupBy("session_id").agg(F.max("action_id").alias("last"), F.count("*").alias("step_length"))
    expected = rows(log.join(starts, "session_id"))
    assert rows(sessions.join_sessions(log, starts)) == expected
    for long_session in (0, 2, 3, 100):
        assert rows(sessions.join_sessions(log, starts, long=sessions.long_sessions(starts, long_session))) == expected


def test_a_declared_size_is_checked(spark):
    log = actions(spark, [{"session_id": s} for s in "abc"])
    wanted = log.select("session_id").distinct()
    with pytest.raises(Exception, match="more than the 2 rows"):
        sessions.detail_of_few(log, wanted, 2).collect()


def test_null_sessions_are_a_session_everywhere(spark):
    log = actions(spark, [{"session_id": s, "click_category_id": 4} for s in ("a", None, None)])
    found = sessions.aggregate_sessions(log)
    assert found.count() == 2
    assert sessions.session_detail(log, found).count() == 3
    assert sessions.session_detail(log, found, sessions.long_sessions(found, 1)).count() == 3
    assert sorted(r.click_count for r in categories.session_category_activity(log, found).collect()) == [1, 2]
    assert page_flow.page_steps(log).count() == 3
    assert page_flow.page_steps(log, 2).count() == 3


@pytest.mark.parametrize("passes", [True, False])
def test_a_hot_session_is_not_shuffled(spark, passes):
    """A session with a third of the log: its rows stay in the tasks that read them, also where it fails the filter."""
    log = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string"))).alias("session_id"), F.col("id").alias("action_id"))
    log = log.repartition(6, "action_id")
    sizes = log.groupBy("session_id").agg(F.count("*").alias("step_length"))
    wanted = sizes if passes else sizes.where("session_id <> 'hot'")
    joined = sessions.join_sessions(log, wanted.select("session_id"), "left_semi", sessions.long_sessions(sizes, 100))
    hot = joined.where("session_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot >= 6 if passes else hot == 0
    assert joined.count() == (3000 if passes else 2000)


EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]


def test_bucket_edges(spark):
    lengths = spark.createDataFrame([(n, n) for n in EDGES], "visit_length bigint, step_length bigint")
    visits = {row.bucket: row.sessions for row in sessions.visit_length_histogram(lengths).collect()}
    assert list(visits.values()) == [2, 2, 2, 2, 2, 2, 2, 2, 1]
    steps = {row.bucket: row.sessions for row in sessions.step_length_histogram(lengths).collect()}
    assert list(steps.values()) == [2, 2, 2, 2, 2, 7]
    stat = sessions.session_aggr_stat(lengths).first()
    assert stat.session_count == 18
    assert stat.visit_length_1s_3s_ratio == 0.11
    assert stat.visit_length_30m_ratio == 0.06
    assert stat.step_length_60_ratio == 0.39


def test_no_sessions(spark):
    lengths = spark.createDataFrame([], "visit_length bigint, step_length bigint")
    stat = sessions.session_aggr_stat(lengths).first()
    assert stat.session_count == 0
    assert set(stat[1:]) == {None}
    assert {row.sessions for row in sessions.step_length_histogram(lengths).collect()} == {0}


def test_long_lists_do_not_grow_the_plan(spark):
    """50,000 keywords, categories, professions and cities: the same rows as plain Python, and a plan of the same size."""
    log = actions(spark, [{"session_id": f"s{n % 50}", "user_id": n % 50, "search_keyword": f"w{n}", "click_category_id": n * 3} for n in range(400)])
    people = users(spark, *[(n, 20, f"p{n}", f"c{n}", "male") for n in range(50)])

    def wanted(k):
        return TaskParams(
            keywords=[f"w{2 * n}" for n in range(k)] + ["w2"], category_ids=[str(6 * n) for n in range(k)] + ["x"],
            professionals=[f"p{n}" for n in range(k)], cities=[f"c{4 * n}" for n in range(k)],
        )

    few, many = (sessions.filtered_sessions(log, people, wanted(k)) for k in (7, 50_000))
    assert [row.session_id for row in many.orderBy("user_id").collect()] == [f"s{n}" for n in range(0, 50, 4)]
    assert [row.session_id for row in few.collect()] == ["s0"] or {row.session_id for row in few.collect()} == {"s0", "s4"}
    size = [len(df._jdf.queryExecution().toString()) for df in (few, many)]
    assert size[1] < 1.1 * size[0]
