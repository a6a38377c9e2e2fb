"""Exact medians of large, skewed groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS_PER_DECADE = 128
MAX_BUFFERED_VALUES = 500_000


def _slot(value: Column) -> Column:
    """A coarse bucket number that grows with the value (log scale, both signs)."""
    size = F.floor(F.log10(F.abs(value)) * SLOTS_PER_DECADE) + F.lit(1_000_000)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys (``left`` and ``right`` carry aliases l and r)."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])


def weighted_medians(points: DataFrame, keys: list[str], values: list[str], weight: str) -> DataFrame:
    """Exact median of each value column per group, every row counting ``weight`` times.

    The built-in median keeps all distinct values of a group in one buffer. Here a group is spread
    over log-scale slots: slot totals locate the one or two slots that hold the middle ranks, and
    only the values of those slots are ordered. Groups whose values are all NULL give no row.
    """
    measures = F.array(*[F.struct(F.lit(i).alias("_m"), F.col(v).alias("_v")) for i, v in enumerate(values)])
    group = [*keys, "_m"]
    counts = (
        points.select(*keys, F.col(weight).alias("_w"), F.inline(measures))
        .where(F.col("_v").isNotNull())
        .groupBy(*group, _slot(F.col("_v")).alias("_slot"), "_v")
        .agg(F.sum("_w").alias("_n"))
    )

    by_group = Window.partitionBy(*group)
    slots = (
        counts.groupBy(*group, "_slot")
        .agg(F.sum("_n").alias("_slot_n"))
        .withColumn("_total", F.sum("_slot_n").over(by_group))
        .withColumn("_before", F.sum("_slot_n").over(by_group.orderBy("_slot")) - F.col("_slot_n"))
        .withColumn("_lo", F.floor((F.col("_total") - 1) / 2))
        .withColumn("_hi", F.floor(F.col("_total") / 2))
        .where("_before <= _hi and _before + _slot_n > _lo")
    )

    l, r = counts.alias("l"), slots.alias("r")
    in_slot = Window.partitionBy(*group, "_slot").orderBy("_v")
    ranked = (
        l.join(r, same_keys(l, r, [*group, "_slot"]))
        .select("l.*", "_before", "_lo", "_hi")
        .withColumn("_end", F.col("_before") + F.sum("_n").over(in_slot))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(rank: str, measure: int) -> Column:
        hit = (F.col("_m") == measure) & (F.col("_start") <= F.col(rank)) & (F.col("_end") > F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    return ranked.groupBy(*keys).agg(
        *[(at("_lo", i) * 0.5 + at("_hi", i) * 0.5).alias(v) for i, v in enumerate(values)]
    )


def group_with_medians(
    points: DataFrame,
    keys: list[str],
    medians: dict[str, str],
    weight: str,
    others: tuple[Column, ...] = (),
    max_values: int = MAX_BUFFERED_VALUES,
) -> DataFrame:
    """Group ``points`` with exact medians (value column -> result name) and ``others`` aggregates.

    ``points`` is a written table with a row per distinct value and its ``weight``. While no group has
    more than ``max_values`` points, the built-in percentile may buffer a group and one shuffle does
    it all; else the medians go through ``weighted_medians``.
    """
    widest = points.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if widest <= max_values:
        exact = [F.percentile(F.col(v), 0.5, F.col(weight)).alias(name) for v, name in medians.items()]
        return points.groupBy(*keys).agg(*others, *exact)
    spread = weighted_medians(points, keys, list(medians), weight)
    spread = spread.select(*keys, *[F.col(v).alias(f"_{name}") for v, name in medians.items()])
    base = points.groupBy(*keys).agg(F.count("*").alias("_points"), *others)
    l, r = base.alias("l"), spread.alias("r")
    found = l.join(r, same_keys(l, r, keys), "left")
    return found.select("l.*", *[F.col(f"_{name}").alias(name) for name in medians.values()]).drop("_points")
