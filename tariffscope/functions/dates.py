"""Dates and timestamps written in more than one way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flexible_date(text: Column) -> Column:
    """``2026-07-01`` or ``7/1/2026`` -> DATE, anything else -> NULL."""
    return F.coalesce(F.try_to_date(text, "yyyy-M-d"), F.try_to_date(text, "M/d/yyyy"))


def iso_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)
