"""Billing codes held as an array of {code, type}."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_codes(codes: Column) -> Column:
    """Trim codes, upper-case types, drop entries without a code."""
    tidy = F.transform(
        codes, lambda c: F.struct(F.trim(c["code"]).alias("code"), F.upper(F.trim(c["type"])).alias("type"))
    )
    return F.filter(tidy, lambda c: F.coalesce(c["code"], F.lit("")) != "")


def first_of_type(codes: Column, *types: str) -> Column:
    return F.get(F.filter(codes, lambda c: c["type"].isin(*types)), 0)


def primary_code(codes: Column) -> Column:
    """The code that names the service: first CPT or HCPCS, else first MS-DRG."""
    return F.coalesce(first_of_type(codes, "CPT", "HCPCS"), first_of_type(codes, "MS-DRG"))


def billing_code(primary: Column) -> Column:
    """DRG numbers lose leading zeros; other codes are upper-cased."""
    return F.when(primary["type"] == "MS-DRG", F.regexp_replace(primary["code"], "^0+", "")).otherwise(
        F.upper(primary["code"])
    )


def billing_code_type(primary: Column) -> Column:
    """A five-character code of CPT shape is CPT even under an HCPCS label."""
    cpt_shape = (primary["type"] == "HCPCS") & primary["code"].rlike(r"^[0-9]{4}[0-9A-Z]\z")
    return F.when(cpt_shape, "CPT").otherwise(primary["type"])


def code_signature(codes: Column) -> Column:
    """Every code of the item in one sorted text; never NULL for a non-NULL list."""
    labels = F.transform(codes, lambda c: F.concat(c["type"], F.lit(":"), c["code"]))
    return F.coalesce(F.array_join(F.sort_array(labels), ","), F.lit(""))
