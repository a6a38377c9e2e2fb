"""Gapless numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, by: list[str], row: str, name: str, per_task: int = 50_000) -> DataFrame:
    """Adds ``name``: 0, 1, 2... within each value of ``by``, without gathering a value in one task.

    Rows of a value are spread over hash ranges of the unique column ``row``, sized by the row count; each
    range is numbered by itself and starts where the ranges before it end.
    """
    ranges = max(16, rows.count() // per_task)
    spread = rows.withColumn("_range", F.pmod(F.xxhash64(row), F.lit(ranges)))
    sizes = spread.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(row)) - 1
    return spread.withColumn("_own", own).join(starts, [*by, "_range"]).withColumn(name, (F.col("_start") + F.col("_own")).cast("bigint")).drop("_range", "_own", "_start")
