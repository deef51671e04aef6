"""Random sample of sessions, spread over days evenly and over hours by traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import divide_down, format_date
from footfall.operators.sessions import aggregate_sessions, detail_of_few, render_lists

DEFAULT_SAMPLE_SIZE = 100

# Slices of the draws of an hour: by their first three hexadecimal digits.
_SLICES, _DIGITS = 4096, 3


def _with_start_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns({"date": format_date("start_time"), "hour": F.hour("start_time")})


def session_hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per date and hour of their start."""
    return _with_start_hour(sessions).groupBy("date", "hour").agg(F.count("*").alias("sessions"))


def session_sample_quota(hour_counts: DataFrame, total: int = DEFAULT_SAMPLE_SIZE, more: tuple[str, ...] = ()) -> DataFrame:
    """Sessions to draw from each hour; columns named in ``more`` are kept.

    Each day with sessions gets ``total`` divided by the number of days, rounded down;
    each hour its share of that by sessions, rounded down and at most all of them.
    The input has at most 24 rows a day, so the window over all of it stays small.
    """
    in_day = Window.partitionBy("date")
    everything = Window.partitionBy()
    opens_day = F.row_number().over(in_day.orderBy("hour")) == 1
    per_day = divide_down(F.lit(total).cast("bigint"), F.col("days"))
    share = divide_down(F.col("sessions") * per_day, F.col("day_sessions"))
    return (
        hour_counts.withColumns({"day_sessions": F.sum("sessions").over(in_day), "opens_day": opens_day})
        .withColumn("days", F.count_if("opens_day").over(everything))
        .select("date", "hour", "sessions", "day_sessions", F.least(share, F.col("sessions")).alias("quota"), *more)
    )


def sample_sessions(sessions: DataFrame, total: int = DEFAULT_SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """Ids of the sampled sessions, drawn in each hour by the hash of session id and seed.

    The same sessions, total and seed always give the same sample: in each hour the sessions of
    the smallest draws. An hour's draws are counted in slices, in the map tasks; the slice in
    which the quota is reached is its cut. Sessions below the cut are in the sample, those above
    are not, and only the sessions of that slice, one in ``_SLICES``, are put in order. The cuts
    have at most 24 rows a day and are broadcast.
    """
    draw = F.md5(F.concat("session_id", F.lit(str(seed))).cast("binary"))
    # A session without an id has no draw, and comes first.
    piece = F.coalesce(F.conv(F.substring("draw", 1, _DIGITS), 16, 10).cast("int"), F.lit(-1))
    drawn = _with_start_hour(sessions).select("date", "hour", "session_id", draw.alias("draw")).withColumn("slice", piece)
    cuts = F.broadcast(_sample_cuts(drawn, total))
    below = drawn.join(cuts, ["date", "hour"]).where("slice <= cut")
    # Each session below the cut is a group of its own.
    alone = F.when(F.col("slice") < F.col("cut"), F.xxhash64("session_id"))
    in_slice = Window.partitionBy("date", "hour", alone).orderBy("draw", "session_id")
    place = F.when(F.col("slice") == F.col("cut"), F.row_number().over(in_slice)).otherwise(F.lit(0))
    return below.withColumn("place", place).where("place <= rest").select("session_id")


def _sample_cuts(drawn: DataFrame, total: int) -> DataFrame:
    """Of each hour with a quota: the slice in which it is reached (cut), and what is left of it there (rest)."""
    slices = drawn.groupBy("date", "hour", "slice").agg(F.count("*").alias("n"))
    hours = slices.groupBy("date", "hour").agg(F.sum("n").alias("sessions"), F.collect_list(F.struct("slice", "n")).alias("slices"))
    quota = session_sample_quota(hours, total, ("slices",)).where("quota > 0")
    upto = F.sum("n").over(Window.partitionBy("date", "hour").orderBy("slice"))
    counted = quota.select("date", "hour", "quota", F.inline("slices")).withColumn("upto", upto)
    reached = counted.where("upto - n < quota AND quota <= upto")
    return reached.select("date", "hour", F.col("slice").alias("cut"), F.expr("quota - (upto - n)").alias("rest"))


def sampled_detail(actions: DataFrame, sampled: DataFrame, total: int = DEFAULT_SAMPLE_SIZE) -> DataFrame:
    """Actions of the sampled sessions, of which there are at most ``total``."""
    return detail_of_few(actions, sampled, total)


def sample_report(detail: DataFrame) -> DataFrame:
    """Sampled sessions with start time, keywords and categories, from their actions.

    The lists are made here, for the sampled sessions only.
    """
    return render_lists(aggregate_sessions(detail)).select(
        "session_id", "start_time", "search_keywords", "click_category_ids"
    )
