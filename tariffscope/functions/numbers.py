"""Rounding and rate arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int = 0) -> Column:
    """Round the double itself, not its shortest decimal spelling (1.005 -> 1.0)."""
    scale = float(10**digits)
    return F.round(x * scale, 0) / scale


def effective_rate(dollar: Column, percentage: Column, list_price: Column) -> Column:
    """The dollar rate, or the percentage of the list price."""
    return F.coalesce(dollar, percentage / 100.0 * list_price)


def rate_source(dollar: Column, percentage: Column, list_price: Column, algorithm: Column) -> Column:
    return (
        F.when(dollar.isNotNull(), "dollar")
        .when(percentage.isNotNull() & list_price.isNotNull(), "derived_from_percentage")
        .when(algorithm.isNotNull(), "algorithm_only")
    )
