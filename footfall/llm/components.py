"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged


def _print(edges: DataFrame):
    """Count and a sum of hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), any order, of one type that has an order; returns (node, label) of all nodes with an edge.

    The label is the smallest node of the component. Each round links a node's larger
    neighbours to its smallest neighbour and then its smaller ones, and is written, so that
    plans stay short; the number of rounds is logarithmic in practice, and two for stars.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _print(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(small.union(down).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        after = _print(now)
        if after == before:
            break
        before = after
    found = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found.union(found.select(F.col("label").alias("node"), "label").distinct())
