"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (or the smaller) neighbours of each node to the smallest node around it."""
    both = edges.union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    told = both.join(least, "a")
    told = told.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) if large else (
        told.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    )
    return told.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes; every step is a join whose result is
    written, so no step holds a component in one task and a lost executor costs one step.
    """
    now = materialize(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = materialize(_star(_star(now, True), False), "edges")
        sums = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if sums == mark:
            break
        mark = sums
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
