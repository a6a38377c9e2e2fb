"""The negotiated-rate fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.functions import numbers as N
from tariffscope.operators import payers as P
from tariffscope.operators import prices as R
from tariffscope.operators.lookup import broadcast_if_small, lookup_join
from tariffscope.session import materialize

# The fact columns in order.
FACT_COLUMNS = """rate_key hospital_id billing_code billing_code_type description setting modifiers
payer_key code_signature gross_charge discounted_cash list_price_match negotiated_dollar
negotiated_percentage negotiated_algorithm effective_rate rate_source methodology median_amount
p10_amount p90_amount allowed_count is_shoppable""".split()

# The parts of the rate key in order; NULL parts vanish.
RATE_KEY = "hospital_id description code_signature setting modifiers payer_name plan_name".split()


def build_payers(staged: DataFrame, patterns: DataFrame) -> DataFrame:
    """The payer dimension as a written table."""
    return materialize(P.payer_dimension(P.payer_pairs(staged), patterns), "payers")


def build_prices(coded: DataFrame) -> DataFrame:
    """Resolved list prices as a written table."""
    points = materialize(R.price_points(coded), "price_points")
    return materialize(R.resolved_prices(points), "list_prices")


def negotiated_rates(
    coded: DataFrame, payers: DataFrame, prices: DataFrame, services: DataFrame, shoppable_only: bool = False
) -> DataFrame:
    """One row per negotiated rate. ``payers`` and ``prices`` are written tables.

    ``shoppable_only`` keeps the compared services and drops the rest before the price join.
    """
    marks = broadcast_if_small(
        services.select(
            F.col("billing_code").alias("s_code"),
            F.col("billing_code_type").alias("s_type"),
            F.lit(True).alias("is_shoppable"),
        )
    )
    service = (F.col("billing_code") == F.col("s_code")) & (F.col("billing_code_type") == F.col("s_type"))
    rows = coded.where(F.col("payer_name").isNotNull()).join(marks, service, "inner" if shoppable_only else "left")
    rows = rows.drop("gross_charge", "discounted_cash", "s_code", "s_type")

    dim = payers.select("payer_key", "payer_name", "plan_name", "n_rows")
    # prices first: most often only they need a shuffle, and payer names shrink in it where payer keys do not
    rows = lookup_join(rows.withColumn("item_key", R.item_key()), prices, ["item_key"], "n_rows")
    rows = lookup_join(rows, dim, ["payer_name", "plan_name"], "n_rows", nullable=["plan_name"])

    dollar, percent, gross = F.col("negotiated_dollar"), F.col("negotiated_percentage"), F.col("gross_charge")
    return rows.withColumns(
        {
            "rate_key": F.md5(F.concat_ws("|", *RATE_KEY)),
            "effective_rate": N.effective_rate(dollar, percent, gross),
            "rate_source": N.rate_source(dollar, percent, gross, F.col("negotiated_algorithm")),
            "is_shoppable": F.coalesce("is_shoppable", F.lit(False)),
        }
    ).select(*FACT_COLUMNS)
