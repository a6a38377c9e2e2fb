"""Stored quantile sketches that merge: medians of any grouping without reading the rates again.

A KLL sketch of a hospital's rates is a few kilobytes whatever their number. Sketches of several hospitals, or of
several loads of one, merge into the sketch of all their rates, so a changed hospital costs its own sketch only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.operators.marts import GRAIN

#: Size parameter of the stored sketches.
SKETCH_SIZE = 200
#: What is sketched: rate column -> result name.
MEASURES = {"effective_rate": "median_rate", "median_amount": "median_actually_paid"}


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a quantile may be off, as a share of all values, for 99 of 100 sketches.

    The figure published for KLL sketches; merging does not add to it.
    """
    return 2.296 / size**0.9723


def rate_sketches(rates: DataFrame, keys: list[str] = ("hospital_id", *GRAIN), size: int = SKETCH_SIZE) -> DataFrame:
    """One row per hospital and mart group: number of rates and a sketch of each measure, to be stored."""
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"{c}_sketch") for c in MEASURES]
    counts = [F.count(c).alias(f"n_{c}") for c in MEASURES]
    return rates.groupBy(*keys).agg(*counts, *sketches)


def merged_medians(sketches: DataFrame, keys: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Medians of any coarser grouping, from stored sketches; NULL where a measure has no value.

    The value returned stands at a rank within ``rank_error`` of the middle.
    """
    merged = sketches.groupBy(*keys).agg(
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in MEASURES],
        *[F.kll_merge_agg_double(F.when(F.col(f"n_{c}") > 0, F.col(f"{c}_sketch")), F.lit(size)).alias(f"{c}_sketch") for c in MEASURES],
    )
    medians = [F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(f"{c}_sketch", F.lit(0.5))).alias(out) for c, out in MEASURES.items()]
    return merged.select(*keys, *[f"n_{c}" for c in MEASURES], *medians)


def ranks_of(values: DataFrame, found: DataFrame, keys: list[str], value: str, estimate: str) -> DataFrame:
    """Where an estimate really stands: shares of the group's values below it and up to it, by exact counts.

    ``values`` are combined by value before they meet the estimates, of which there is one for each group.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    told = counts.join(found.select(*keys, F.col(estimate).alias("_e")), list(keys))
    below = F.sum(F.when(F.col(value) < F.col("_e"), F.col("_n")).otherwise(0)) / F.sum("_n")
    upto = F.sum(F.when(F.col(value) <= F.col("_e"), F.col("_n")).otherwise(0)) / F.sum("_n")
    return told.groupBy(*keys).agg(below.alias("below"), upto.alias("upto"))
