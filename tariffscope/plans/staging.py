"""Cleaned inputs and the small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.functions import codes as C
from tariffscope.functions import numbers as N
from tariffscope.functions.dates import flexible_date, iso_timestamp

# The staged columns in order.
STAGED_COLUMNS = """hospital_id description codes setting modifiers payer_name plan_name
gross_charge discounted_cash min_charge max_charge negotiated_dollar negotiated_percentage
negotiated_algorithm methodology median_amount p10_amount p90_amount allowed_count
estimated_amount""".split()


def stage_charges(charges: DataFrame) -> DataFrame:
    """Trimmed names, lower-case setting and methodology, no rows without a description."""
    trimmed = {c: F.trim(c) for c in ("description", "payer_name", "plan_name")}
    lowered = {c: F.lower(F.trim(c)) for c in ("setting", "methodology")}
    return charges.where(F.col("description").isNotNull()).select(
        *[(trimmed | lowered).get(c, F.col(c)).alias(c) for c in STAGED_COLUMNS]
    )


def stage_hospitals(hospitals: DataFrame) -> DataFrame:
    return hospitals.select(
        "hospital_id",
        "hospital_name",
        flexible_date(F.col("last_updated_on")).alias("last_updated_on"),
        F.col("version").alias("schema_version"),
        F.get("type_2_npi", F.lit(0)).alias("type_2_npi"),
        F.when(F.col("type_2_npi").isNotNull(), F.size("type_2_npi")).cast("long").alias("npi_count"),
        "license_number",
        "license_state",
        "attestation_confirmed",
        "source_file",
        "source_format",
        F.col("row_count").alias("source_row_count"),
        iso_timestamp(F.col("parsed_at")).alias("parsed_at"),
    )


def dim_hospital(staged_hospitals: DataFrame) -> DataFrame:
    return staged_hospitals.select(
        "hospital_id", "hospital_name", "type_2_npi", "last_updated_on", "schema_version",
        "source_format", "source_row_count", "attestation_confirmed", "parsed_at",
    )


def dim_service(services: DataFrame) -> DataFrame:
    return services.withColumnRenamed("code_type", "billing_code_type")


def with_billing_code(staged: DataFrame) -> DataFrame:
    """Staged charges plus billing code, its type, the code signature and the row's own rate."""
    primary = F.col("_primary")
    dollar, percent = F.col("negotiated_dollar"), F.col("negotiated_percentage")
    gross, algorithm = F.col("gross_charge"), F.col("negotiated_algorithm")
    return staged.withColumn("_primary", C.primary_code(F.col("codes"))).withColumns(
        {
            "billing_code": C.billing_code(primary),
            "billing_code_type": C.billing_code_type(primary),
            "code_signature": C.code_signature(F.col("codes")),
            "effective_rate": N.effective_rate(dollar, percent, gross),
            "rate_source": N.rate_source(dollar, percent, gross, algorithm),
        }
    ).drop("_primary")
