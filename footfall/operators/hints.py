"""Broadcast only what has a known bound."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when ``max_rows``, its largest possible size, is small.

    ``df`` should hold only a few narrow columns. The size is checked when the query runs:
    a frame with more rows is an error, and no more than ``max_rows + 1`` are ever sent.
    Beyond BROADCAST_ROWS Spark is left to choose the join from the sizes it finds.
    """
    if max_rows > BROADCAST_ROWS:
        return df
    counted = df.limit(max_rows + 1).withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy()))
    fits = F.assert_true(F.col("__rows") <= max_rows, F.lit(f"more than the {max_rows} rows that were declared"))
    return F.broadcast(counted.where(fits.isNull()).drop("__rows"))
