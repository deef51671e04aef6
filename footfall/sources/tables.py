"""Input tables: Parquet, catalog tables and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.functions import parse_time
from footfall.schemas import ACTION_ID, CITY_INFO, USER_VISIT_ACTION


def read_table(spark: SparkSession, name_or_path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet folder when ``name_or_path`` holds a slash, else a view or catalog table."""
    df = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)
    return df if schema is None else conform(df, schema)


def conform(df: DataFrame, schema: StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types; a missing column is an error.

    Columns named in ``optional`` are kept when present.
    """
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    extra = [name for name in optional if name in df.columns]
    return df.select(*[F.col(field.name).cast(field.dataType) for field in schema], *extra)


def read_actions(
    spark: SparkSession, name_or_path: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """The action log. Times may be stored as text, also with one-digit hours.

    Text that is not a time becomes NULL. Store the log partitioned by ``date``: a date
    range then reads only its own folders. Bounds that are given here are put on the dates
    as they are stored, as text or as DATE, so they reach the scan of either.
    """
    df = read_table(spark, name_or_path)
    if start_date and end_date and "date" in df.columns:
        kind = df.schema["date"].dataType
        df = df.where(F.col("date").between(*(F.lit(bound).cast(kind) for bound in (start_date, end_date))))
    if "action_time" in df.columns:
        df = df.withColumn("action_time", parse_time("action_time"))
    return conform(df, USER_VISIT_ACTION, (ACTION_ID,))


def action_date_range(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Actions of the dates from ``start_date`` to ``end_date``, both included.

    ``yyyy-MM-dd`` text sorts like dates, so this is a plain column filter that reaches
    the scan.
    """
    if not start_date or not end_date:
        raise ValueError("both a start date and an end date are needed")
    return actions.where(F.col("date").between(start_date, end_date))


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of Spark's JDBC source and sink."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver, **extra}
    return {name: str(value) for name, value in options.items() if value is not None}


def jdbc_split_options(column: str, low, high, partitions: int) -> dict[str, str]:
    """Options that read a large JDBC table in ``partitions`` ranges of ``column``.

    The bounds only place the cuts; rows outside them are read as well.
    """
    if partitions < 1:
        raise ValueError("at least one partition is needed")
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A JDBC table; filters and column selection are sent to the database."""
    return spark.read.format("jdbc").options(**options).load()


def city_info(df: DataFrame) -> DataFrame:
    """City table with typed columns; its id may be of any number or text type."""
    return conform(df, CITY_INFO)
