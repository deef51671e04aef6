"""Run one job for one task, for use with spark-submit.

    python -m footfall session|page-flow|area --task-id 7 --tasks ... --actions ... --out ...

Tables are Parquet folders (any name with a slash) or catalog tables; the task and city
tables may also be read through JDBC. Results go to Parquet folders under --out, or
without it to the database of --jdbc-url.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from footfall.params import load_task
from footfall.plans import jobs
from footfall.schemas import PRODUCT_INFO, USER_INFO
from footfall.sources.results import JdbcResults, ParquetResults
from footfall.sources.tables import city_info, jdbc_options, jdbc_split_options, read_actions, read_jdbc, read_table


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="footfall", description=__doc__)
    options.add_argument("job", choices=["session", "page-flow", "area"])
    options.add_argument("--task-id", type=int, required=True)
    options.add_argument("--tasks", default="task", help="task table")
    options.add_argument("--tasks-from-jdbc", action="store_true", help="read the task table through --jdbc-url")
    options.add_argument("--actions", default="user_visit_action", help="action log")
    options.add_argument("--users", default="user_info", help="user table (session job)")
    options.add_argument("--products", default="product_info", help="product table (area job)")
    options.add_argument("--cities", default="city_info", help="city table (area job)")
    options.add_argument("--cities-from-jdbc", action="store_true", help="read the city table through --jdbc-url")
    options.add_argument("--sample-size", type=int, default=100, help="sampled sessions (session job)")
    options.add_argument("--seed", type=int, default=42, help="seed of the sample (session job)")
    options.add_argument("--out", help="folder of the result tables")
    options.add_argument("--jdbc-url")
    options.add_argument("--jdbc-user")
    options.add_argument("--jdbc-password")
    options.add_argument("--jdbc-driver")
    options.add_argument("--jdbc-split", nargs=4, metavar=("COLUMN", "LOW", "HIGH", "PARTITIONS"), help="read JDBC tables in ranges of a column")
    options.add_argument("--hive", action="store_true", help="find catalog tables in the Hive metastore")
    return options


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    def jdbc(table: str) -> dict[str, str]:
        return jdbc_options(args.jdbc_url, table, args.jdbc_user, args.jdbc_password, args.jdbc_driver)

    if not args.out and not args.jdbc_url:
        raise ValueError("either --out or --jdbc-url is needed")
    split = jdbc_split_options(*args.jdbc_split[:3], int(args.jdbc_split[3])) if args.jdbc_split else {}

    def small_table(name: str, from_jdbc: bool) -> DataFrame:
        return read_jdbc(spark, jdbc(name) | split) if from_jdbc else read_table(spark, name)

    results = ParquetResults(args.out) if args.out else JdbcResults(jdbc(""))
    params = load_task(small_table(args.tasks, args.tasks_from_jdbc), args.task_id)
    actions = read_actions(spark, args.actions, *params.date_range())
    if args.job == "session":
        users = read_table(spark, args.users, USER_INFO)
        jobs.run_session_analysis(actions, users, params, args.task_id, results, args.sample_size, args.seed)
    elif args.job == "page-flow":
        jobs.run_page_flow(actions, params, args.task_id, results)
    else:
        cities = small_table(args.cities, args.cities_from_jdbc)
        products = read_table(spark, args.products, PRODUCT_INFO)
        jobs.run_area_top_products(actions, city_info(cities), products, params, args.task_id, results)


def main() -> None:
    args = parser().parse_args()
    builder = SparkSession.builder.appName(f"footfall-{args.job}")
    spark = (builder.enableHiveSupport() if args.hive else builder).getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
