"""Optional session filters. A filter whose parameter is absent lets every row pass;
a row whose value is missing fails a filter that is present."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.hints import small
from footfall.params import TaskParams


def in_range(column: str, low: int | None, high: int | None) -> Column | None:
    """``low <= column <= high``; a range with only one bound is no filter."""
    if low is None or high is None:
        return None
    return F.coalesce(F.col(column).between(low, high), F.lit(False))


def in_list(column: str, values: list | None) -> Column | None:
    """Value of a scalar column is one of ``values``."""
    if not values:
        return None
    return F.coalesce(F.col(column).isin(values), F.lit(False))


def overlaps_list(column: str, values: list | None, element_type: str = "string") -> Column | None:
    """Array column holds at least one of ``values``."""
    if not values:
        return None
    wanted = F.array(*[F.lit(value).try_cast(element_type) for value in values])
    return F.coalesce(F.arrays_overlap(F.col(column), wanted), F.lit(False))


def equals(column: str, value: str | None) -> Column | None:
    if not value:
        return None
    return F.coalesce(F.col(column) == value, F.lit(False))


def user_predicates(params: TaskParams) -> list[Column]:
    """Filters of ``params`` on the columns of the user."""
    return _present(
        in_range("age", params.start_age, params.end_age),
        in_list("professional", params.professionals),
        in_list("city", params.cities),
        equals("sex", params.sex),
    )


def session_predicates(params: TaskParams) -> list[Column]:
    """All filters of ``params``, over sessions with user columns and arrays."""
    return user_predicates(params) + _present(
        overlaps_list("search_keywords", params.keywords),
        overlaps_list("click_category_ids", params.category_ids, "bigint"),
    )


def listed(spark: SparkSession, values: list, column: str, element_type: str = "string") -> DataFrame:
    """A parameter list as a table of its distinct values; what is not of the type is left out."""
    texts = sorted({str(value) for value in values if value is not None})
    table = spark.createDataFrame([(text,) for text in texts], "value string")
    typed = table.select(F.col("value").try_cast(element_type).alias(column)).where(F.col(column).isNotNull())
    return small(typed.distinct(), len(texts))


def keep_listed(df: DataFrame, column: str, values: list | None, element_type: str = "string") -> DataFrame:
    """Rows whose value is in a list of any length; all rows where there is no list."""
    return df.join(listed(df.sparkSession, values, column, element_type), column, "left_semi").select(*df.columns) if values else df


def mark_listed(df: DataFrame, column: str, values: list, flag: str) -> DataFrame:
    """df with a flag: whether the value is in a list of any length; a missing value is not."""
    table = listed(df.sparkSession, values, "__listed", df.schema[column].dataType.simpleString())
    return df.join(table, F.col(column) == F.col("__listed"), "left").withColumn(flag, F.col("__listed").isNotNull()).drop("__listed")


def action_lists(params: TaskParams) -> dict[str, tuple[str, list]]:
    """Filters of ``params`` that a session passes by one of its actions: flag -> column and list."""
    lists = {"by_keyword": ("search_keyword", params.keywords), "by_category": ("click_category_id", params.category_ids)}
    return {name: (column, values) for name, (column, values) in lists.items() if values}


def filter_users(users: DataFrame, params: TaskParams) -> DataFrame:
    """Users that pass the filters of ``params``; lists are semi-joined."""
    users = keep_all(users, _present(in_range("age", params.start_age, params.end_age), equals("sex", params.sex)))
    return keep_listed(keep_listed(users, "professional", params.professionals), "city", params.cities)


def _present(*filters: Column | None) -> list[Column]:
    return [condition for condition in filters if condition is not None]


def keep_all(df: DataFrame, predicates: list[Column]) -> DataFrame:
    """Rows that pass every predicate, as one conjunction."""
    return df.where(reduce(lambda left, right: left & right, predicates)) if predicates else df


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that pass every filter of ``params``.

    Catalyst moves the conditions on user columns below the user join.
    """
    return keep_all(sessions, session_predicates(params))
