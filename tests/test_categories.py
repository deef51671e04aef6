import random

from helpers import actions, rows

from footfall.operators import categories

LOG = [
    {"session_id": "a", "click_category_id": 1},
    {"session_id": "a", "click_category_id": 1},
    {"session_id": "b", "click_category_id": 2},
    {"session_id": "a", "order_category_ids": "1,3"},
    {"session_id": "b", "order_category_ids": "1,,3,"},
    {"session_id": "b", "order_category_ids": ""},
    {"session_id": "b", "pay_category_ids": "4,bad"},
    {"session_id": "c", "pay_category_ids": "3"},
    {"session_id": "c"},
]


def test_counts(spark):
    log = actions(spark, LOG)
    assert rows(categories.category_ids(log)) == [(1,), (2,), (3,), (4,)]
    assert rows(categories.category_click_counts(log)) == [(1, 2), (2, 1)]
    assert rows(categories.category_order_counts(log)) == [(1, 2), (3, 2)]
    assert rows(categories.category_pay_counts(log)) == [(3, 1), (4, 1)]
    assert rows(categories.category_counts(log)) == [(1, 2, 2, 0), (2, 1, 0, 0), (3, 0, 2, 1), (4, 0, 0, 1)]


def test_one_pass_equals_joined_counts(spark):
    random.seed(3)
    pick = lambda: ",".join(str(random.randint(0, 5)) for _ in range(random.randint(0, 3)))
    log = actions(
        spark,
        [
            {
                "session_id": random.choice("abcd"),
                "click_category_id": random.choice([None, 1, 2, 3]),
                "order_category_ids": random.choice([None, pick()]),
                "pay_category_ids": random.choice([None, pick()]),
            }
            for _ in range(60)
        ],
    )
    joined = categories.join_category_counts(
        categories.category_ids(log),
        categories.category_click_counts(log),
        categories.category_order_counts(log),
        categories.category_pay_counts(log),
    )
    assert rows(categories.category_counts(log)) == rows(joined)
    some = spark.createDataFrame([("a",), ("c",)], "session_id string")
    activity = categories.session_category_activity(log, some)
    detail = log.join(some, "session_id", "left_semi")
    assert rows(categories.total_activity(activity)) == rows(categories.category_counts(detail))
    assert rows(categories.clicked(activity)) == rows(categories.session_category_clicks(detail))


COUNTS = "category_id bigint, click_count bigint, order_count bigint, pay_count bigint"


def test_ranking_is_by_clicks_then_orders_then_pays_then_id(spark):
    big = 3_000_000_000
    counts = spark.createDataFrame(
        [(1, 5, 0, 9), (2, 5, 1, 0), (3, 5, 1, 2), (4, big, 0, 0), (5, 0, 0, 0), (6, 5, 1, 2), (7, 1, 0, 0)], COUNTS
    )
    ranked = [(row["rank"], row.category_id) for row in categories.rank_categories(counts).collect()]
    assert sorted(ranked) == list(enumerate([4, 3, 6, 2, 1, 7, 5], start=1))
    assert [row.category_id for row in categories.top_categories(counts, 3).collect()] == [4, 3, 6]


def test_ranking_holds_every_category(spark):
    counts = spark.range(250).selectExpr("id AS category_id", "id % 7 AS click_count", "id % 3 AS order_count", "0L AS pay_count")
    expected = sorted(range(250), key=lambda n: (-(n % 7), -(n % 3), n))
    ranked = sorted((row["rank"], row.category_id) for row in categories.rank_categories(counts).collect())
    assert ranked == list(enumerate(expected, start=1))


def test_top_sessions(spark):
    clicks = spark.createDataFrame(
        [(1, f"s{n:02}", n % 4) for n in range(20)] + [(2, "x", 1), (3, "y", 9)],
        "category_id bigint, session_id string, click_count bigint",
    )
    top = spark.createDataFrame([(1, 9, 0, 0), (2, 8, 0, 0)], COUNTS)
    chosen = categories.top_sessions(categories.top_category_session_clicks(clicks, top))
    expected = sorted((-(n % 4), f"s{n:02}") for n in range(20))[:10]
    assert rows(chosen) == sorted([(1, s, -c) for c, s in expected] + [(2, "x", 1)])


def test_detail_of_a_session_in_two_lists_comes_once(spark):
    log = actions(spark, LOG)
    top = spark.createDataFrame([(1, "b", 1), (2, "b", 1)], "category_id bigint, session_id string, click_count bigint")
    assert categories.top_session_detail(log, top).count() == 4
