"""The comparison views readers see, and the ordered exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.operators.marts import COMMERCIAL, percent_contract
from tariffscope.operators.medians import group_with_medians
from tariffscope.session import materialize
from tariffscope.sources.seeds import local_table

# Insurance types in display order, and the marker of invented hospitals.
PRODUCT_LINES = [
    "Commercial", "Medicare Advantage", "Medicaid", "Medicare (traditional)", "Other government", "Workers comp",
]
DEMO_MARK = "FICTIONAL"
TOP_SERVICES = 12

VIEW = ["billing_code", "product_line"]


def selection(prices: DataFrame, billing_code: str, product_line: str) -> DataFrame:
    """Mart rows of one service and one insurance type."""
    return prices.where((F.col("billing_code") == billing_code) & (F.col("product_line") == product_line))


def _by_hospital(prices: DataFrame) -> DataFrame:
    return prices.groupBy(*VIEW, "hospital_name").agg(
        F.min("min_rate").alias("lowest_rate"),
        F.max("max_rate").alias("highest_rate"),
        F.median("median_rate").alias("hospital_median"),
        F.min_by("cash_price", "payer_group").alias("cash_price"),
        F.min_by("gross_charge", "payer_group").alias("gross_charge"),
    )


def hospital_summary(prices: DataFrame) -> DataFrame:
    """One row per service, insurance type and hospital: range, median of carrier medians, cash, list."""
    return _by_hospital(prices).orderBy(*VIEW, F.asc_nulls_last("hospital_median"), "hospital_name")


def service_spread(prices: DataFrame) -> DataFrame:
    """Cheapest and dearest hospital per service and insurance type; a ratio only from two on."""
    rank = F.struct("hospital_median", "hospital_name")
    low, high = F.min("hospital_median"), F.max("hospital_median")
    ratio = F.when(F.count("*") > 1, high / F.nullif(low, F.lit(0.0)))
    return (
        _by_hospital(prices)
        .groupBy(*VIEW)
        .agg(
            F.count("*").alias("hospitals"),
            F.min_by("hospital_name", rank).alias("lowest_hospital"),
            low.alias("lowest_median"),
            F.max_by("hospital_name", rank).alias("highest_hospital"),
            high.alias("highest_median"),
            ratio.alias("spread"),
        )
    )


def insurer_median(prices: DataFrame) -> DataFrame:
    """Median across insurers and the number of hospital-insurer pairs behind it."""
    return prices.groupBy(*VIEW).agg(
        F.median("median_rate").alias("median_across_insurers"), F.count("*").alias("pairs")
    )


def contract_types(rates: DataFrame) -> DataFrame:
    """Commercial medians of percentage contracts against fee schedules, inside each hospital."""
    keys = ["hospital_name", "service_name", "billing_code", "contract_type"]
    kind = F.when(percent_contract(), "percentage of list price").when(
        F.col("methodology") == "fee schedule", "fee schedule"
    )
    points = (
        rates.where(F.col("product_line") == COMMERCIAL)
        .withColumn("contract_type", kind)
        .where("contract_type is not null")
        .groupBy(*keys, "effective_rate")
        .agg(F.count("*").alias("n"))
    )
    stored = materialize(points, "contract_points")
    return group_with_medians(stored, keys, {"effective_rate": "median_rate"}, "n")


def service_list(prices: DataFrame) -> DataFrame:
    """Services that occur, once per billing code, by category and name."""
    return (
        prices.groupBy("billing_code")
        .agg(F.min(F.struct("category", "service_name")).alias("s"))
        .select("billing_code", "s.category", "s.service_name")
        .orderBy("category", "service_name", "billing_code")
    )


def product_lines_present(prices: DataFrame) -> DataFrame:
    """Insurance types that occur, in display order."""
    rows = [{"position": i, "product_line": line} for i, line in enumerate(PRODUCT_LINES)]
    fixed = local_table(prices.sparkSession, rows, ["position", "product_line"])
    return fixed.join(prices.select("product_line").distinct(), "product_line", "left_semi").orderBy("position")


def top_dispersion(dispersion: DataFrame, n: int = TOP_SERVICES) -> DataFrame:
    return ordered_dispersion(dispersion).limit(n)


def ordered_prices(prices: DataFrame) -> DataFrame:
    return prices.orderBy("category", "service_name", "hospital_name", "payer_group", "product_line")


def ordered_dispersion(dispersion: DataFrame) -> DataFrame:
    return dispersion.orderBy(F.desc_nulls_last("high_to_low_ratio"), "billing_code")


def ordered_hospitals(hospitals: DataFrame) -> DataFrame:
    return hospitals.select(
        "hospital_name", F.col("last_updated_on").cast("string").alias("last_updated_on"),
        "schema_version", "source_format",
    ).orderBy("hospital_name")


def is_demo(hospitals: DataFrame) -> DataFrame:
    """One row: does any hospital carry the mark of invented data?"""
    return hospitals.agg(
        F.coalesce(F.bool_or(F.contains("hospital_name", F.lit(DEMO_MARK))), F.lit(False)).alias("is_demo")
    )
