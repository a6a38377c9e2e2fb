"""List prices: per item, per item in any setting, per billing code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffscope.operators.lookup import lookup_join
from tariffscope.operators.medians import group_with_medians
from tariffscope.session import materialize

ITEM = ["hospital_id", "description", "code_signature", "modifiers"]
ITEM_SETTING = [*ITEM, "setting"]
CODE = ["hospital_id", "billing_code", "billing_code_type"]
ITEM_CODE = [*ITEM_SETTING, "billing_code", "billing_code_type"]
PRICES = ["gross_charge", "discounted_cash"]


def price_points(coded: DataFrame) -> DataFrame:
    """Distinct list prices per item with their row counts.

    The one pass over the charges for all three price levels: payer rows of an item repeat its
    prices, so they collapse before the shuffle.
    """
    return coded.groupBy(*ITEM_CODE, *PRICES).agg(F.count("*").alias("n_rows"))


def _highest(points: DataFrame, keys: list[str]) -> DataFrame:
    return points.groupBy(*keys).agg(*[F.max(p).alias(p) for p in PRICES])


def item_prices(points: DataFrame) -> DataFrame:
    return _highest(points, ITEM_SETTING)


def item_prices_any_setting(points: DataFrame) -> DataFrame:
    return _highest(points, ITEM)


def code_prices(points: DataFrame) -> DataFrame:
    """Median list and cash price per billing code, over rows that carry a list price, and the
    number of price points under the code. ``points`` is a written table."""
    has_list = F.when(F.col("gross_charge").isNotNull(), F.col("discounted_cash"))
    coded = points.where("billing_code is not null").withColumn("discounted_cash", has_list)
    grouped = group_with_medians(
        coded, CODE, {p: p for p in PRICES}, "n_rows", others=(F.count("*").alias("n_points"),)
    )
    return grouped.where("gross_charge is not null")


def _digest(*parts: Column | str) -> Column:
    """Sixteen bytes that name the parts; NULL parts count as values."""
    return F.unhex(F.md5(F.concat_ws("\u0001", *[F.coalesce(c, F.lit("\u0000")) for c in parts])))


def _item() -> Column:
    return _digest(*ITEM)


def item_key(item: Column | None = None) -> Column:
    """One join key for an item (its digest) in a setting under a billing code."""
    return _digest(F.hex(_item() if item is None else item), "setting", "billing_code", "billing_code_type")


def resolved_prices(points: DataFrame) -> DataFrame:
    """The list price each item ends up with: item_key, prices, level, and the rows behind it.

    ``points`` is a written table. Levels are resolved here, on the item table, so that the much
    larger fact needs a single join on a short key.
    """
    # Items go by their digest, and are dealt by it once, for the aggregate and both windows. A partition of these
    # windows holds one item: its settings and code orders.
    short = points.select(_item().alias("_item"), "setting", *CODE, *PRICES, "n_rows").repartition("_item")
    per_item = short.groupBy("_item", "setting", *CODE).agg(
        *[F.max(p).alias(p) for p in PRICES], F.sum("n_rows").alias("n_rows")
    )
    any_setting, same = Window.partitionBy("_item"), Window.partitionBy("_item", "setting")
    levels = per_item.withColumns({f"any_{p}": F.max(p).over(any_setting) for p in PRICES})
    levels = levels.withColumns({f"same_{p}": F.max(p).over(same) for p in PRICES}).drop(*PRICES)
    by_code = code_prices(points).withColumnsRenamed({p: f"code_{p}" for p in PRICES})
    found = lookup_join(levels, materialize(by_code, "code_prices"), CODE, "n_points", how="left")
    gross = F.coalesce("same_gross_charge", "any_gross_charge", "code_gross_charge")
    cash = F.coalesce("same_discounted_cash", "any_discounted_cash", "code_discounted_cash")
    return found.select(
        item_key(F.col("_item")).alias("item_key"),
        "n_rows",
        gross.alias("gross_charge"),
        cash.alias("discounted_cash"),
        F.when(F.col("same_gross_charge").isNotNull(), "same item")
        .when(F.col("any_gross_charge").isNotNull(), "same item, other setting")
        .when(F.col("code_gross_charge").isNotNull(), "same billing code")
        .alias("list_price_match"),
    )
