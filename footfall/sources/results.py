"""Result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from footfall.schemas import RESULT_COLUMNS


def result_rows(df: DataFrame, table: str, task_id: int) -> DataFrame:
    """``df`` as the rows of a result table: task_id, then the columns of the table by name."""
    if table not in RESULT_COLUMNS:
        raise ValueError(f"unknown result table {table}")
    columns = RESULT_COLUMNS[table]
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{table} needs columns: {', '.join(missing)}")
    return df.select(F.lit(task_id).cast("bigint").alias("task_id"), *columns)


class ParquetResults:
    """Result tables as Parquet folders ``root/table/task_id=N``.

    Writing a task again replaces its folder, also by an empty result, so a job may be rerun
    after a failure. The rows are written aside, and only when all of them are there does Spark
    put them in the place of the folder (a dynamic partition overwrite): a run that fails leaves
    the result of the run before, and the results of other tasks are not touched.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def write(self, df: DataFrame, table: str, task_id: int) -> None:
        rows, written = result_rows(df, table, task_id), Observation()
        counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
        swap = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        swap.partitionBy("task_id").parquet(f"{self.root}/{table}")
        if not written.get.get("n"):
            # No row names the folder, so it was left; nothing is computed for this write.
            rows.limit(0).drop("task_id").write.mode("overwrite").parquet(f"{self.root}/{table}/task_id={int(task_id)}")


class JdbcResults:
    """Result tables in a database, through Spark's JDBC writer.

    Rows are appended in batches, one transaction per partition, over at most
    ``connections`` connections. Rows of an earlier run of the same task are not deleted.
    """

    def __init__(self, options: dict[str, str], batch_size: int = 1000, connections: int = 10):
        self.options = {name: value for name, value in options.items() if name != "dbtable"}
        self.connections = connections
        self.options |= {"batchsize": str(batch_size), "numPartitions": str(connections)}

    def write(self, df: DataFrame, table: str, task_id: int) -> None:
        # Spark would meet numPartitions by a coalesce, which takes the stage before it along: the log
        # would be read by as many tasks. Dealing the result rows anew leaves that stage as it is.
        rows = result_rows(df, table, task_id).repartition(self.connections)
        writer = rows.write.format("jdbc").mode("append")
        writer.options(**self.options, dbtable=table).save()
