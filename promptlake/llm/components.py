"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to a row (node, root) for each node that isn't the smallest of its component.

    Every round is two aggregations and joins by node, cut by a checkpoint; the
    number of rounds grows with the logarithm of a component's width.
    """
    ends = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = settled(ends)
    seen = _state(now)
    while seen[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # a > b in every row of large
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = low.select("a", F.col("m").alias("b")).union(large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        now = settled(small)
        last, seen = seen, _state(now)
        if last == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
