"""Date and time expressions over wall-clock timestamps or their text."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(value) -> Column:
    """Timestamp of a time text, NULL when it is not one. Hours may have one digit.

    A cast is used rather than a format, because a format with ``HH`` rejects ``9:05:00``.
    """
    value = F.col(value) if isinstance(value, str) else value
    return value.try_cast("timestamp_ntz")


def format_time(value) -> Column:
    """Time text such as ``2024-01-01 09:05:00``; fractions of a second are dropped."""
    return F.substring(parse_time(value).cast("string"), 1, 19)


def format_date(value) -> Column:
    """Date text such as ``2024-01-01``."""
    return parse_time(value).cast("date").cast("string")


def date_hour(value) -> Column:
    """Date and hour key, such as ``2024-01-01_09``."""
    return F.translate(F.substring(parse_time(value).cast("string"), 1, 13), " ", "_")


def before(first, second) -> Column:
    """Whether ``first`` is earlier; false when either is not a time."""
    return F.coalesce(parse_time(first) < parse_time(second), F.lit(False))


def after(first, second) -> Column:
    """Whether ``first`` is later; false when either is not a time."""
    return F.coalesce(parse_time(first) > parse_time(second), F.lit(False))


def seconds_between(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later``, cut toward zero; 0 when either is not a time.

    The times are wall-clock times: a change to summer time between them does not count.
    """
    gap = parse_time(later) - parse_time(earlier)
    parts = [("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1)]
    seconds = reduce(add, [F.extract(F.lit(name), gap) * size for name, size in parts])
    return F.coalesce(seconds.cast("bigint"), F.lit(0).cast("bigint"))


def today() -> Column:
    return F.current_date().cast("string")


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1).cast("string")
