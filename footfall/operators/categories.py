"""Counts and rankings of clicked, ordered and paid categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.hints import small
from footfall.operators.sessions import detail_of_few
from footfall.operators.topn import first_n

TOP_CATEGORIES = 10
TOP_SESSIONS = 10

_RANKING = [F.desc, F.desc, F.desc, F.asc]
_COUNTS = ["click_count", "order_count", "pay_count"]


def _one_per_id(df: DataFrame, column: str) -> DataFrame:
    """A row per id of a comma text, as category_id; empty and bad parts are dropped."""
    return (
        df.withColumn("category_id", F.explode(F.split(column, ",")))
        .withColumn("category_id", F.col("category_id").try_cast("bigint"))
        .where("category_id IS NOT NULL")
        .drop(column)
    )


def category_events(detail: DataFrame) -> DataFrame:
    """One row per category that an action clicked, ordered or paid, in one pass.

    Columns: session_id, kind (``click``, ``order`` or ``pay``), category_id. A clicked id
    stays a number; only the comma lists are split.
    """
    acted = detail.where("click_category_id IS NOT NULL OR order_category_ids IS NOT NULL OR pay_category_ids IS NOT NULL")
    clicked = F.array(_event("click", F.col("click_category_id").cast("bigint")))
    every = F.concat(clicked, _listed("order", "order_category_ids"), _listed("pay", "pay_category_ids"))
    return acted.select("session_id", F.inline(every)).where("category_id IS NOT NULL")


def _event(kind: str, category_id) -> Column:
    return F.struct(F.lit(kind).alias("kind"), category_id.alias("category_id"))


def _listed(kind: str, column: str) -> Column:
    """An event for each part of a comma text; none for NULL."""
    events = F.transform(F.split(column, ","), lambda part: _event(kind, part.try_cast("bigint")))
    return F.coalesce(events, F.array().cast("array<struct<kind:string,category_id:bigint>>"))


def category_ids(detail: DataFrame) -> DataFrame:
    """Distinct categories that were clicked, ordered or paid."""
    return category_events(detail).select("category_id").distinct()


def category_click_counts(detail: DataFrame) -> DataFrame:
    return _count(detail.select(F.col("click_category_id").alias("category_id")).where("category_id IS NOT NULL"))


def category_order_counts(detail: DataFrame) -> DataFrame:
    return _count(_one_per_id(detail.select("order_category_ids").where("order_category_ids IS NOT NULL"), "order_category_ids"))


def category_pay_counts(detail: DataFrame) -> DataFrame:
    return _count(_one_per_id(detail.select("pay_category_ids").where("pay_category_ids IS NOT NULL"), "pay_category_ids"))


def _count(ids: DataFrame) -> DataFrame:
    return ids.groupBy("category_id").agg(F.count("*").alias("n"))


def join_category_counts(categories: DataFrame, clicks: DataFrame, orders: DataFrame, pays: DataFrame) -> DataFrame:
    """Categories with their three counts; a missing count is 0."""
    joined = categories
    for counts, name in zip((clicks, orders, pays), _COUNTS):
        joined = joined.join(counts.withColumnRenamed("n", name), "category_id", "left")
    return joined.fillna(0, _COUNTS).select("category_id", *_COUNTS)


def session_category_activity(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clicks, orders and pays of each of ``sessions`` in each category.

    The log is counted before the sessions are selected: the join then has one row per
    session and category, however many actions a session has.
    """
    activity = _kind_counts(category_events(actions), "category_id", "session_id")
    wanted = sessions.select(F.col("session_id").alias("__session"))
    return activity.join(wanted, F.expr("session_id <=> __session"), "left_semi").select(
        "category_id", "session_id", *_COUNTS
    )


def category_counts(detail: DataFrame) -> DataFrame:
    """The result of ``join_category_counts`` over ``detail``, from one pass and one shuffle."""
    return _kind_counts(category_events(detail), "category_id")


def _kind_counts(events: DataFrame, *keys: str) -> DataFrame:
    counts = [F.count_if(F.col("kind") == kind).alias(name) for kind, name in zip(("click", "order", "pay"), _COUNTS)]
    return events.groupBy(*keys).agg(*counts)


def total_activity(activity: DataFrame) -> DataFrame:
    """Category counts from the per-session counts of ``session_category_activity``."""
    return activity.groupBy("category_id").agg(*[F.sum(name).alias(name) for name in _COUNTS])


def top_categories(counts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """First ``n`` categories by clicks, then orders, then pays, most first; ties by id."""
    order = [direction(name) for direction, name in zip(_RANKING, [*_COUNTS, "category_id"])]
    return counts.orderBy(*order).limit(n)


def rank_categories(counts: DataFrame, keep=lambda df: df.persist()) -> DataFrame:
    """All categories with their rank from 1, in the order of ``top_categories``.

    The categories are dealt by ranges of that order; each range is ranked on its own, after
    as many places as the ranges before it have rows (one number per range). ``keep`` makes
    the dealt rows once for both, since ranges may be cut otherwise a second time.
    """
    order = [direction(name) for direction, name in zip(_RANKING, [*_COUNTS, "category_id"])]
    ranges = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keep(counts.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()))
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__size"))
    before = sizes.select("__range", (F.sum("__size").over(Window.orderBy("__range")) - F.col("__size")).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    ranked = dealt.withColumn("__place", place).join(F.broadcast(before), "__range")
    return ranked.select(*counts.columns, (F.col("__before") + F.col("__place")).cast("int").alias("rank"))


def clicked(activity: DataFrame) -> DataFrame:
    """The result of ``session_category_clicks`` from per-session counts."""
    return activity.where("click_count > 0").select("category_id", "session_id", "click_count")


def session_category_clicks(detail: DataFrame) -> DataFrame:
    """Clicks of each session in each category."""
    return (
        detail.where("click_category_id IS NOT NULL")
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count("*").alias("click_count"))
    )


def top_category_session_clicks(clicks: DataFrame, top: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """Session clicks in the ``n`` categories of ``top`` only.

    As a semi-join on a grouping key, Spark runs it before the clicks are counted.
    """
    return clicks.join(small(top.select("category_id"), n), "category_id", "left_semi").select(
        "category_id", "session_id", "click_count"
    )


def top_sessions(clicks: DataFrame, n: int = TOP_SESSIONS) -> DataFrame:
    """First ``n`` sessions of each category by clicks, most first; ties by session id."""
    return first_n(clicks, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n).drop("rank")


def top_session_detail(
    actions: DataFrame, top: DataFrame, n: int = TOP_CATEGORIES * TOP_SESSIONS
) -> DataFrame:
    """Actions of the sessions of ``top``, at most ``n`` of them; each action once."""
    return detail_of_few(actions, top, n)
