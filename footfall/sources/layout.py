"""A layout of the log that keeps the rows of a session together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.operators.sessions import order_columns


def write_by_session(actions: DataFrame, table: str, buckets: int) -> None:
    """Write the log as a catalog table bucketed by session; the rows of a session in order.

    Each bucket is one file. What groups or joins by session reads such a table without a
    shuffle. Choose as many buckets as make files of a few hundred MB. A session stays in one
    file, so a log in which one session outgrows a task is better kept plain.
    """
    dealt = actions.repartition(buckets, "session_id")
    writer = dealt.write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, "session_id").sortBy("session_id", *order_columns(actions)).saveAsTable(table)


def read_by_session(spark: SparkSession, table: str) -> DataFrame:
    """The log of ``write_by_session``."""
    return spark.table(table)
