"""Session aggregates, their join with users, and length histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import comma_list, is_not_empty, ratio, seconds_between
from footfall.operators.filters import action_lists, filter_users, keep_all, mark_listed
from footfall.operators.hints import small
from footfall.params import TaskParams
from footfall.schemas import (
    ACTION_ID,
    DETAIL_COLUMNS,
    SESSION_COLUMNS,
    STEP_RATIOS,
    USER_COLUMNS,
    VISIT_RATIOS,
)

# A session with more actions than this is not handled by one task.
LONG_SESSION = 5_000_000

# Bucket name -> inclusive bounds (fixed values; None is open). A visit of 0 seconds
# is in no bucket.
VISIT_BUCKETS = {
    "1s_3s": (1, 3),
    "4s_6s": (4, 6),
    "7s_9s": (7, 9),
    "10s_30s": (10, 30),
    "30s_60s": (31, 60),
    "1m_3m": (61, 180),
    "3m_10m": (181, 600),
    "10m_30m": (601, 1800),
    "30m": (1801, None),
}
STEP_BUCKETS = {
    "1_3": (1, 3),
    "4_6": (4, 6),
    "7_9": (7, 9),
    "10_30": (10, 30),
    "30_60": (31, 60),
    "60": (61, None),
}


def order_columns(actions: DataFrame) -> list[str]:
    """Columns that put the actions of a session in order.

    Time decides, then the row id. A log without row ids falls back on the page, so
    that actions that still tie are alike.
    """
    return ["action_time", ACTION_ID if ACTION_ID in actions.columns else "page_id"]


def aggregate_sessions(actions: DataFrame, **extra: Column) -> DataFrame:
    """One row per session, with keywords and clicked categories as arrays.

    Everything is a mergeable aggregate, so a session that holds much of the log is
    reduced in the map tasks and no task ever sees its rows together. The arrays are the
    costly part; readers that do not select them do not pay for them. ``extra`` are more
    aggregates by name.
    """
    earliest = F.when(F.col("action_time").isNotNull(), F.struct(*order_columns(actions), "user_id"))
    start, end = F.min("action_time"), F.max("action_time")
    return (
        actions.groupBy("session_id")
        .agg(
            F.min_by("user_id", earliest).alias("user_id"),
            F.collect_set(F.when(is_not_empty("search_keyword"), F.col("search_keyword"))).alias("search_keywords"),
            F.collect_set("click_category_id").alias("click_category_ids"),
            seconds_between(end, start).alias("visit_length"),
            F.count("*").alias("step_length"),
            start.alias("start_time"),
            *[column.alias(name) for name, column in extra.items()],
        )
        .select(*SESSION_COLUMNS, *extra)
    )


def join_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add user columns; sessions of unknown users are dropped.

    No hint is given: Spark broadcasts the users when they are small, and else splits
    the partitions of users with many sessions at run time.
    """
    return sessions.join(users.select("user_id", *USER_COLUMNS), "user_id").select(*sessions.columns, *USER_COLUMNS)


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions with user columns that pass the filters of ``params``.

    Equal to ``filter_sessions`` over the joined sessions, but keywords and categories
    are tested action by action, as flags of the session, and not on the arrays.
    """
    return matching_sessions(flagged_sessions(actions, params), users, params)


def flagged_sessions(actions: DataFrame, params: TaskParams) -> DataFrame:
    """All sessions, with a flag for each list of ``params`` that one of their actions decides.

    The lists are tables that the log is joined with, so a plan does not grow with them.
    """
    lists = action_lists(params)
    for name, (column, values) in lists.items():
        actions = mark_listed(actions, column, values, name)
    return aggregate_sessions(actions, **{name: F.coalesce(F.bool_or(name), F.lit(False)) for name in lists})


def matching_sessions(flagged: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """``filtered_sessions`` from the result of ``flagged_sessions``."""
    flags = list(action_lists(params))
    return join_users(keep_all(flagged, [F.col(name) for name in flags]), filter_users(users, params)).drop(*flags)


def render_lists(sessions: DataFrame) -> DataFrame:
    """Array columns as comma text, for output."""
    return sessions.withColumns({name: comma_list(name) for name in ("search_keywords", "click_category_ids")})


def detail_columns(actions: DataFrame) -> list[str]:
    return [name for name in [*DETAIL_COLUMNS, ACTION_ID] if name in actions.columns]


def long_sessions(sessions: DataFrame, more_than: int = LONG_SESSION) -> DataFrame:
    """Ids of the sessions with more than ``more_than`` actions, from their aggregates.

    There are fewer of them than one per ``more_than`` actions of the log, so the result
    may be broadcast.
    """
    return sessions.where(F.col("step_length") > more_than).select("session_id")


def join_sessions(actions: DataFrame, sessions: DataFrame, how: str = "inner", long: DataFrame | None = None) -> DataFrame:
    """Join actions with ``sessions``, which has one row per session, on the session.

    A NULL session id is a session like any other, here and in every other operator.

    Where ``sessions`` is read from a table or a checkpoint, Spark splits a session with
    very many actions by itself. Where it is an aggregate over the same key, Spark does not:
    then ``long`` names those sessions, by ``long_sessions`` of the aggregate before any
    filter. Their actions stay where they are read, and the rows of their sessions are sent
    to them; the actions of a long session that fails a filter are dropped there too.
    """
    if long is None:
        return _on_session(actions, sessions, how)
    long = F.broadcast(long)
    ordinary = _on_session(_on_session(actions, long, "left_anti"), sessions, how)
    long_rows = F.broadcast(_on_session(sessions, long, "left_semi"))
    return ordinary.unionByName(_on_session(_on_session(actions, long, "left_semi"), long_rows, how))


def _on_session(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    named = right.withColumnRenamed("session_id", "__session")
    return left.join(named, F.expr("session_id <=> __session"), how).drop("__session")


def join_in_buckets(actions: DataFrame, sessions: DataFrame, how: str = "inner") -> DataFrame:
    """``join_sessions`` for a log bucketed by session and sessions that were aggregated from it: no shuffle.

    The NULL session is joined by itself; only its bucket is read for that.
    """
    named = sessions.withColumnRenamed("session_id", "__session")
    known = actions.join(named, F.col("session_id") == F.col("__session"), how).drop("__session")
    null_rows, null_session = actions.where("session_id IS NULL"), named.where("__session IS NULL")
    unknown = null_rows.join(small(null_session, 1), F.col("session_id").isNull() == F.col("__session").isNull(), how).drop("__session")
    return known.unionByName(unknown)


def session_detail(actions: DataFrame, sessions: DataFrame, long: DataFrame | None = None) -> DataFrame:
    """Actions of the given sessions, each once; ``long`` as in ``join_sessions``."""
    detail = actions.select(*detail_columns(actions))
    return join_sessions(detail, sessions.select("session_id"), "left_semi", long).select(*detail.columns)


def detail_of_few(actions: DataFrame, sessions: DataFrame, at_most: int) -> DataFrame:
    """``session_detail`` for sessions that are known to be few."""
    few = small(sessions.select("session_id").distinct(), at_most)
    return session_detail(actions, few)


def _in_bucket(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def _histogram(sessions: DataFrame, column: str, buckets: dict) -> DataFrame:
    counts = [
        f"struct('{name}' AS bucket, count_if({_in_bucket(column, low, high)}) AS sessions)"
        for name, (low, high) in buckets.items()
    ]
    return sessions.agg(F.expr(f"array({', '.join(counts)}) AS counts")).select(F.inline("counts"))


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per bucket of visit length in seconds; every bucket has a row."""
    return _histogram(sessions, "visit_length", VISIT_BUCKETS)


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per bucket of step count; every bucket has a row."""
    return _histogram(sessions, "step_length", STEP_BUCKETS)


def stat_counts() -> list[Column]:
    """The counts that ``session_aggr_stat`` is made of: aggregates over sessions."""
    tests = [_in_bucket("visit_length", *bounds) for bounds in VISIT_BUCKETS.values()]
    tests += [_in_bucket("step_length", *bounds) for bounds in STEP_BUCKETS.values()]
    names = [*VISIT_RATIOS, *STEP_RATIOS]
    return [F.count("*").alias("session_count"), *[F.expr(f"count_if({test})").alias(name) for name, test in zip(names, tests)]]


def stat_shares(counts: DataFrame) -> DataFrame:
    """The row of ``stat_counts`` as counts of all sessions and shares of each bucket."""
    return counts.select("session_count", *[ratio(name, "session_count").alias(name) for name in [*VISIT_RATIOS, *STEP_RATIOS]])


def session_aggr_stat(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions and the share of each bucket, rounded to 2 places.

    Shares are NULL when there is no session.
    """
    return stat_shares(sessions.agg(*stat_counts()))


def stat_of_totals(spark: SparkSession, totals: dict) -> DataFrame:
    """``session_aggr_stat`` from the values of ``stat_counts``, as they were observed."""
    names = ["session_count", *VISIT_RATIOS, *STEP_RATIOS]
    values = [tuple(totals.get(name, 0) for name in names)]
    return stat_shares(spark.createDataFrame(values, ", ".join(f"{name} bigint" for name in names)))
