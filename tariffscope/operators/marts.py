"""Service price mart, Medicare benchmark and price dispersion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffscope.functions.numbers import round_half_away
from tariffscope.operators.lookup import broadcast_if_small, lookup_join
from tariffscope.operators.medians import group_with_medians
from tariffscope.session import materialize

GRAIN = ["category", "service_name", "billing_code", "hospital_name", "payer_group", "product_line"]

# The mart columns in order, and the product lines the marts look for.
MART_COLUMNS = [
    *GRAIN, "plan_rates", "min_rate", "median_rate", "max_rate", "median_actually_paid",
    "gross_charge", "cash_price", "includes_percentage_rates", "pct_of_medicare",
]
COMMERCIAL = "Commercial"
TRADITIONAL_MEDICARE = "Medicare (traditional)"


def service_rates(fact: DataFrame, services: DataFrame, hospitals: DataFrame, payers: DataFrame) -> DataFrame:
    """Known rates of active payers for the compared services, with the dimension names."""
    rows = fact.where("effective_rate is not null").join(
        broadcast_if_small(services), ["billing_code", "billing_code_type"]
    )
    rows = rows.join(broadcast_if_small(hospitals.select("hospital_id", "hospital_name")), "hospital_id")
    active = payers.where("not is_retired_payer").select("payer_key", "payer_group", "product_line", "n_rows")
    return lookup_join(rows, active, ["payer_key"], "n_rows")


def percent_contract(methodology: str = "methodology", source: str = "rate_source"):
    """Paid as a share of list price, by contract wording or because the rate was derived."""
    return F.col(methodology).like("percent%") | (F.col(source) == "derived_from_percentage")


def rate_points(rates: DataFrame) -> DataFrame:
    """Distinct rates per mart group with their counts, combined before the shuffle."""
    return rates.groupBy(*GRAIN, "effective_rate", "median_amount").agg(
        F.count("*").alias("n"),
        F.max("gross_charge").alias("gross_charge"),
        F.max("discounted_cash").alias("cash_price"),
        F.bool_or(percent_contract()).alias("includes_percentage_rates"),
    )


def service_prices(points: DataFrame) -> DataFrame:
    """The mart without the benchmark. ``points`` is a written table of ``rate_points``."""
    grouped = group_with_medians(
        points,
        GRAIN,
        {"effective_rate": "median_rate", "median_amount": "median_actually_paid"},
        "n",
        others=(
            F.sum("n").alias("plan_rates"),
            F.min("effective_rate").alias("min_rate"),
            F.max("effective_rate").alias("max_rate"),
            F.max("gross_charge").alias("gross_charge"),
            F.max("cash_price").alias("cash_price"),
            F.bool_or("includes_percentage_rates").alias("includes_percentage_rates"),
        ),
    )
    rounded = {c: round_half_away(F.col(c), 2) for c in ("median_rate", "median_actually_paid")}
    return grouped.withColumns(rounded)


def with_benchmark(prices: DataFrame) -> DataFrame:
    """Each rate as a percentage of the same hospital's traditional Medicare rate.

    A window partition holds the carriers and product lines of one service at one hospital.
    """
    at_hospital = Window.partitionBy("billing_code", "hospital_name")
    medicare = F.median(F.when(F.col("product_line") == TRADITIONAL_MEDICARE, F.col("median_rate")))
    benchmark = F.nullif(medicare.over(at_hospital), F.lit(0.0))
    return prices.withColumn(
        "pct_of_medicare", round_half_away(F.lit(100.0) * F.col("median_rate") / benchmark)
    ).select(*MART_COLUMNS)


def mart_service_prices(
    fact: DataFrame, services: DataFrame, hospitals: DataFrame, payers: DataFrame
) -> DataFrame:
    points = materialize(rate_points(service_rates(fact, services, hospitals, payers)), "rate_points")
    return with_benchmark(service_prices(points))


def hospital_medians(prices: DataFrame) -> DataFrame:
    """Commercial median per service and hospital, over the carriers' medians."""
    return (
        prices.where(F.col("product_line") == COMMERCIAL)
        .groupBy("category", "service_name", "billing_code", "hospital_name")
        .agg(round_half_away(F.median("median_rate"), 2).alias("commercial_median"))
    )


def mart_price_dispersion(prices: DataFrame) -> DataFrame:
    """Cheapest and dearest hospital per service, for services that two or more hospitals price."""
    rank = F.struct("commercial_median", "hospital_name")
    low, high = F.min("commercial_median"), F.max("commercial_median")
    return (
        hospital_medians(prices)
        .groupBy("category", "service_name", "billing_code")
        .agg(
            F.count("*").alias("hospitals"),
            low.alias("lowest_hospital_median"),
            high.alias("highest_hospital_median"),
            F.min_by("hospital_name", rank).alias("lowest_hospital"),
            F.max_by("hospital_name", rank).alias("highest_hospital"),
            round_half_away(high / F.nullif(low, F.lit(0.0)), 2).alias("high_to_low_ratio"),
        )
        .where("hospitals >= 2")
    )


def approx_prices(rates: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """The mart's medians by a mergeable sketch: one shuffle, for coarse or huge groups."""
    return rates.groupBy(*GRAIN).agg(
        F.count("*").alias("plan_rates"),
        F.approx_percentile("effective_rate", 0.5, accuracy).alias("median_rate"),
        F.approx_percentile("median_amount", 0.5, accuracy).alias("median_actually_paid"),
    )
