"""First rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark drops rows below rank n before the shuffle for n up to this default of
# spark.sql.optimizer.windowGroupLimitThreshold.
_PRUNED_BEFORE_SHUFFLE = 1000


def first_n(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank from 1. ``order`` must be total.

    For a small ``n`` the map tasks keep ``n`` rows per group each, so even a group with
    most of the rows sends few to its task. For a larger ``n`` each group is first cut
    into parts, as many as there are shuffle partitions, that are ranked on their own; its
    first ``n`` rows are among theirs.
    """
    if n > _PRUNED_BEFORE_SHUFFLE:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).alias("__part")
        df = _ranked(df.select("*", part), [*group, "__part"], order, n, "__part_rank").drop("__part", "__part_rank")
    return _ranked(df, group, order, n, rank)


def _ranked(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= n)
