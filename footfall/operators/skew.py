"""Explicit handling of hot keys, for plans that run-time skew handling does not reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.hints import small


def hot_keys(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """The ``n`` most frequent values of ``key`` with their number of rows: key, n.

    The count is exact: the map tasks reduce the rows to one per key and task, so a sample
    would save little. Ties go to the smaller key.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(n)


# Keys that a summary keeps at most, and the share of all rows by which it may misjudge a count.
_KEPT, _ERROR = 8192, 3.5 / 8192


def heavy_keys(df: DataFrame, key: str, n: int = 1, kept: int = _KEPT) -> DataFrame:
    """``hot_keys``, without a shuffle of every key where the heaviest stand out; runs when it is called.

    A frequent-items summary of at most ``kept`` keys is made in each task and merged. Its
    candidates are counted exactly in a second pass. No other key can have more rows than the
    summary says of its last candidate, or than its error allows (``_ERROR`` of the rows, for
    ``_KEPT`` keys): where the n-th candidate has more than that, the first n are the result.
    Else, as for keys that are all alike, all keys are counted.
    """
    keys = df.where(F.col(key).isNotNull()).select(key)
    wanted = min(10 * n, 10_000, kept)
    summary = F.expr(f"approx_top_k(`{key}`, {wanted}, {kept})").alias("found")
    top = keys.agg(summary, F.count("*").alias("total")).first()
    if top["found"]:
        error = top["total"] * _ERROR * _KEPT / kept
        least = max(error, top["found"][-1]["count"] if len(top["found"]) == wanted else 0)
        names = df.sparkSession.createDataFrame([(row["item"],) for row in top["found"]], df.select(key).schema)
        counts = keys.join(small(names, wanted), key, "left_semi").groupBy(key).agg(F.count("*").alias("n"))
        first = counts.orderBy(F.desc("n"), F.asc(key)).limit(n).collect()
        if len(first) == n and first[-1]["n"] > least:
            return df.sparkSession.createDataFrame(first, counts.schema)
    return hot_keys(df, key, n)


def key_parts(df: DataFrame, key: str, rows_per_part: int) -> DataFrame:
    """Keys with more than ``rows_per_part`` rows, and how many parts of that size they make: key, parts.

    Fewer than one row per ``rows_per_part`` rows of ``df``, so it may be broadcast.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > rows_per_part).select(key, F.ceil(F.col("n") / rows_per_part).alias("parts"))


def dealt(left: DataFrame, parts: DataFrame, key: str, row_id: str | None = None) -> DataFrame:
    """``left`` with ``__part``: for a key of ``parts`` one of its parts, by the hash of the row; else 0."""
    place = F.col(row_id) if row_id else F.monotonically_increasing_id()
    numbered = left.withColumn("__place", F.xxhash64(place)).join(F.broadcast(parts), key, "left")
    part = F.pmod("__place", F.coalesce("parts", F.lit(1)))
    return numbered.withColumn("__part", part).select(*left.columns, "__part")


def skew_join(left: DataFrame, right: DataFrame, key: str, rows_per_part: int = 1_000_000, row_id: str | None = None) -> DataFrame:
    """Inner join on ``key`` whose result equals ``left.join(right, key)``.

    Each key of ``left`` is dealt over as many parts as its rows need at ``rows_per_part`` each,
    also where the rows are equal: a row takes a part by the hash of ``row_id``, a column that
    differs between rows, and the right rows of a key are repeated for each of its parts. A key
    that needs no more than one part has one, so ordinary keys are not repeated.

    Without a row id the place of a row in its input partition takes its part. Then ``left``
    must come in the same order when a lost task is run again, as tables and staged frames do.
    """
    parts = key_parts(left, key, rows_per_part)
    all_parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)
    repeated = right.join(F.broadcast(parts), key, "left").withColumn("__part", F.explode(all_parts)).drop("parts")
    return dealt(left, parts, key, row_id).join(repeated, [key, "__part"]).drop("__part")


def salted_count(df: DataFrame, key: str, salts: int = 10) -> DataFrame:
    """Rows per key, counted in two steps: per key and salt, then per key.

    The salt is the input partition, so each map task sends one row per key and the rows
    of one key go to up to ``salts`` tasks of the first step.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("__salt")
    return (
        df.select(key, salt)
        .groupBy(key, "__salt")
        .agg(F.count("*").alias("n"))
        .groupBy(key)
        .agg(F.sum("n").alias("n"))
    )
