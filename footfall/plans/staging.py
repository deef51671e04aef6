"""Keeping a DataFrame that several actions or branches of a plan read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once for several branches of one plan, for results that are returned unread.

    A checkpoint in the shared folder of ``spark.checkpoint.dir``, which goes when nothing
    refers to it any more; else rows on the executors, with their lineage.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def staged(df: DataFrame):
    """``df`` computed once for several readers.

    Where the cluster names a shared folder in ``spark.checkpoint.dir`` the rows are
    written there, so the loss of an executor costs nothing. Elsewhere they are kept on
    the executors with their lineage, and lost blocks are computed again.
    """
    rows = kept(df)
    try:
        yield rows
    finally:
        rows.unpersist()


@contextmanager
def counted(df: DataFrame, totals: list[Column]) -> Iterator[tuple[DataFrame, dict]]:
    """``df`` computed once for several readers, and the aggregates ``totals`` of all its rows, by name.

    The rows are written to the shared folder, and the totals are observed by the tasks that
    write them: no second read, and a task that is run again counts once, as its file does.
    Without a shared folder the rows are kept on the executors and the totals read from them.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        with staged(df) as rows:
            yield rows, rows.agg(*totals).first().asDict()
        return
    seen, path = Observation(), f"{folder.rstrip('/')}/footfall-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.observe(seen, *totals).write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path), seen.get
    finally:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
