"""One-step conversion along a path of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import ratio
from footfall.operators.sessions import order_columns
from footfall.schemas import ACTION_ID


def step_counts(actions: DataFrame, parts: int | None = None) -> DataFrame:
    """How often each page follows another within a session: prev_page, page, n.

    prev_page is NULL for the first action of a session; n adds up to the number of actions.

    The log is dealt to ``parts`` ranges (as many as there are shuffle partitions) of session,
    time and row id, so a session of any length is cut where its share of the rows is full, also
    within one instant, and sessions of NULL times or the NULL session are cut like others. Each
    session's run of actions in a range is summed up as its pairs of neighbouring pages, counted,
    and the pages at its ends; the ends of runs of one session that follow each other are the
    pairs that are left. What crosses a task after the ranges is a count for each pair of pages
    and one row for each run; the log is read once, and once for Spark's sample of the ranges.

    In a log without row ids, actions of a session that agree in time and page are alike: they
    are one row with a count, and give pairs of that page with itself.
    """
    order = order_columns(actions)
    rows = actions.select("session_id", "page_id", *[name for name in order if name != "page_id"])
    if ACTION_ID in order:
        rows = rows.withColumn("alike", F.lit(1).cast("bigint"))
    else:
        rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("alike"))
    parts = parts or int(actions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number of a range is read in the stage that reads it, once: nothing else deals by it.
    ranges = rows.repartitionByRange(parts, "session_id", *order).withColumn("part", F.spark_partition_id())
    runs = _runs(ranges, order)
    in_order = Window.partitionBy("session_id", "pair").orderBy("part")
    before = F.when(F.col("pair").isNull(), F.lag("last_page").over(in_order)).otherwise(F.col("prev_page"))
    return runs.select(before.alias("prev_page"), "page", "n").groupBy("prev_page", "page").agg(F.sum("n").alias("n"))


def _runs(ranges: DataFrame, order: list[str]) -> DataFrame:
    """prev_page, page, n of the pairs within runs, summed over a range's sessions; and of each run one row
    with session_id, part, its first page, its last_page, and no pair. ``pair`` deals the summed pairs."""
    run = Window.partitionBy("part", "session_id").orderBy(*order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = ranges.select(
        "part", "session_id", "alike",
        F.col("page_id").alias("page"),
        F.lag("page_id").over(run).alias("prev_page"),
        F.row_number().over(run).alias("position"),
        F.last("page_id").over(whole).alias("last_page"),
    )
    opens = F.col("position") == 1
    step = F.struct(F.col("prev_page"), F.col("page"), F.lit(1).cast("bigint").alias("n"), opens.alias("opens"))
    again = F.struct(F.col("page").alias("prev_page"), F.col("page"), (F.col("alike") - 1).alias("n"), F.lit(False).alias("opens"))
    each = placed.select("part", "session_id", "last_page", F.inline(F.when(F.col("alike") > 1, F.array(step, again)).otherwise(F.array(step))))
    of_run = {name: F.when(F.col("opens"), F.col(name)) for name in ("session_id", "part", "last_page")}
    keyed = each.withColumns({**of_run, "pair": F.when(~F.col("opens"), F.xxhash64("prev_page", "page"))})
    return keyed.groupBy("session_id", "pair", "part", "prev_page", "page", "last_page").agg(F.sum("n").alias("n"))


def steps_in_buckets(actions: DataFrame) -> DataFrame:
    """``page_steps`` for a log bucketed by session, whose sessions each fit a task: no shuffle."""
    in_order = Window.partitionBy("session_id").orderBy(*order_columns(actions))
    return actions.select(F.lag("page_id").over(in_order).alias("prev_page"), F.col("page_id").alias("page"))


def page_steps(actions: DataFrame, parts: int | None = None) -> DataFrame:
    """Each action's page with the page before it in its session: prev_page, page.

    One row per action, from ``step_counts``; lists of repeats stay short.
    """
    step = 100_000
    counts = step_counts(actions, parts).select("prev_page", "page", "n", F.explode(F.expr(f"sequence(0, (n - 1) div {step})")).alias("block"))
    return counts.select("prev_page", "page", F.explode(F.expr(f"sequence(1, least({step}, n - block * {step}))"))).select("prev_page", "page")


def _views(steps: DataFrame) -> Column:
    """The actions that a row stands for: one, or a count."""
    return F.col("n") if "n" in steps.columns else F.lit(1).cast("bigint")


def split_name(prev_page, page) -> str:
    return f"{prev_page}_{page}"


def flow_splits(flow: list[int]) -> list[tuple[int, int]]:
    """Steps of a page flow as (from, to) pairs; a flow of one page has none."""
    return list(zip(flow, flow[1:]))


def page_split_views(steps: DataFrame, flow: list[int]) -> DataFrame:
    """Views of each step of ``flow`` that occurs: split (``from_to``), pv. Steps are rows or counts."""
    names = sorted({split_name(*pair) for pair in flow_splits(flow)})
    split = F.concat_ws("_", "prev_page", "page")
    return (
        steps.where(F.col("prev_page").isin(flow) & F.col("page").isin(flow))
        .select(split.alias("split"), _views(steps).alias("n"))
        .where(F.col("split").isin(names))
        .groupBy("split")
        .agg(F.sum("n").alias("pv"))
    )


def start_page_views(actions: DataFrame, flow: list[int]) -> DataFrame:
    """All views of the first page of ``flow``, also those that lead nowhere."""
    start = F.lit(flow[0]).cast("bigint")
    return actions.where(F.col("page_id") == start).agg(start.alias("page_id"), F.count("*").alias("pv"))


def page_convert_rate(steps: DataFrame, flow: list[int]) -> DataFrame:
    """Conversion of each step of ``flow``: step, split, pv, prev_pv, rate.

    ``prev_pv`` is the views of the step before, and for step 1 all views of the start
    page. The rate is NULL when it is 0. A split that occurs twice in the flow has a row
    for each step. All counts come from one aggregate over the steps, so nothing is
    joined and each task sends one row.
    """
    pairs = flow_splits(flow)
    if not pairs:
        return steps.sparkSession.createDataFrame([], "step int, split string, pv bigint, prev_pv bigint, rate double")
    tests = {"start": f"page = {flow[0]}"}
    tests |= {split_name(*pair): f"prev_page = {pair[0]} AND page = {pair[1]}" for pair in pairs}
    views = _views(steps)
    counts = steps.agg(*[F.coalesce(F.sum(F.when(F.expr(test), views)), F.lit(0)).alias(name) for name, test in tests.items()])
    names = ["start", *[split_name(*pair) for pair in pairs]]
    rows = [
        f"struct({step} AS step, '{names[step]}' AS split, `{names[step]}` AS pv, `{names[step - 1]}` AS prev_pv)"
        for step in range(1, len(names))
    ]
    return counts.selectExpr(f"inline(array({', '.join(rows)}))").withColumn("rate", ratio("pv", "prev_pv"))


def page_convert_rate_text(rates: DataFrame) -> DataFrame:
    """One row ``from_to=rate|from_to=rate`` in step order; no row for an empty flow.

    A split that occurs twice is named once, with its last rate. An undefined rate is
    written as ``null``. The input has one row per step of the flow.
    """
    entry = F.concat("split", F.lit("="), F.coalesce(F.col("rate").cast("string"), F.lit("null")))
    last = rates.groupBy("split").agg(F.max("step").alias("step"), F.max_by(entry, "step").alias("entry"))
    entries = F.array_sort(F.collect_list(F.struct("step", "entry")))
    return last.agg(F.array_join(F.transform(entries, lambda e: e["entry"]), "|").alias("convert_rate")).where(
        "convert_rate != ''"
    )
