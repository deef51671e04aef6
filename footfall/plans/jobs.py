"""The three jobs: read parameters, derive the results, write each by its own action."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.operators import areas, categories, page_flow, sampling, sessions
from footfall.params import TaskParams
from footfall.plans.staging import counted, staged
from footfall.sources.tables import action_date_range


def run_session_analysis(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: int,
    results,
    sample_size: int = sampling.DEFAULT_SAMPLE_SIZE,
    seed: int = 42,
) -> None:
    """Statistics, sample, top categories and top sessions of the sessions that match ``params``.

    The matching sessions are computed once, and the statistics are counted as they are written;
    so are their counts by category, and the rankings read only those counts. Nothing but the parameters is on the driver.
    """
    actions = action_date_range(actions, *params.date_range())
    matching = sessions.filtered_sessions(actions, users, params)
    matching = matching.select("session_id", "start_time", "visit_length", "step_length")
    with counted(matching, sessions.stat_counts()) as (matching, totals):
        results.write(sessions.stat_of_totals(actions.sparkSession, totals), "session_aggr_stat", task_id)
        with staged(sampling.sample_sessions(matching, sample_size, seed)) as sampled:
            detail = sampling.sampled_detail(actions, sampled, sample_size)
            results.write(sampling.sample_report(detail), "session_random_extract", task_id)
            results.write(detail, "session_detail", task_id)
        with staged(categories.session_category_activity(actions, matching)) as activity:
            _write_rankings(actions, activity, task_id, results)


def _write_rankings(actions: DataFrame, activity: DataFrame, task_id: int, results) -> None:
    with staged(categories.top_categories(categories.total_activity(activity))) as top:
        results.write(top, "top10_category", task_id)
        clicks = categories.top_category_session_clicks(categories.clicked(activity), top)
        with staged(categories.top_sessions(clicks)) as busiest:
            results.write(busiest, "top10_session", task_id)
            results.write(categories.top_session_detail(actions, busiest), "top10_session_detail", task_id)


def page_convert_rates(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Conversion of each step of the task's page flow."""
    actions = action_date_range(actions, *params.date_range())
    return page_flow.page_convert_rate(page_flow.step_counts(actions), params.page_flow())


def run_page_flow(actions: DataFrame, params: TaskParams, task_id: int, results) -> None:
    """Conversion along the task's page flow, as one text row."""
    rates = page_convert_rates(actions, params)
    results.write(page_flow.page_convert_rate_text(rates), "page_split_convert_rate", task_id)


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame, params: TaskParams) -> DataFrame:
    """Most clicked products of each area in the task's date range."""
    clicks = areas.click_city_product(action_date_range(actions, *params.date_range()))
    by_area = areas.area_product_clicks(clicks, cities)
    return areas.area_top_products(areas.area_full_product_clicks(by_area, products))


def run_area_top_products(
    actions: DataFrame, cities: DataFrame, products: DataFrame, params: TaskParams, task_id: int, results
) -> None:
    results.write(area_top_products(actions, cities, products, params), "area_top3_product", task_id)
