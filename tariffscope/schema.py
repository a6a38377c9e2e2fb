"""Fixed table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

CODES = T.ArrayType(T.StructType([T.StructField("code", T.StringType()), T.StructField("type", T.StringType())]))


def _struct(spec: str, **special: T.DataType) -> T.StructType:
    """Build a StructType from ``name:kind`` words; ``special`` names carry their own type."""
    kinds = {
        "str": T.StringType(),
        "dbl": T.DoubleType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "bool": T.BooleanType(),
        "list": T.ArrayType(T.StringType()),
    }
    fields = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, special.get(name) or kinds[kind or "str"]))
    return T.StructType(fields)


# Column names and types of the long charges table.
CHARGES = _struct(
    """description codes setting modifiers drug_unit drug_unit_type
    gross_charge:dbl discounted_cash:dbl min_charge:dbl max_charge:dbl
    payer_name plan_name negotiated_dollar:dbl negotiated_percentage:dbl
    negotiated_algorithm methodology median_amount:dbl p10_amount:dbl p90_amount:dbl
    allowed_count estimated_amount:dbl notes""",
    codes=CODES,
)

# The partition column is a string even when every id looks like a number.
CHARGES_STORED = T.StructType([*CHARGES.fields, T.StructField("hospital_id", T.StringType())])

# One metadata record per price file.
HOSPITALS = _struct(
    """hospital_id hospital_name last_updated_on version
    location_name:list hospital_address:list type_2_npi:list
    license_number license_state attestation_confirmed:bool attester_name
    source_file source_format row_count:long parsed_at
    repaired_quote_lines:long non_utf8_lines:long"""
)

PAYER_PATTERNS = _struct("pattern payer_group priority:int product_line")
SERVICES = _struct("billing_code code_type service_name category")


def differences(actual: T.StructType, contract: T.StructType) -> list[str]:
    """Schema drift between a DataFrame and its contract, as readable lines (empty: none)."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in contract}
    out = [f"missing {name}: {want[name]}" for name in want if name not in have]
    out += [f"unexpected {name}: {have[name]}" for name in have if name not in want]
    out += [f"{n}: {have[n]} instead of {want[n]}" for n in want if n in have and have[n] != want[n]]
    shared = [n for n in have if n in want]
    if not out and shared != list(want):
        out.append(f"column order {shared} instead of {list(want)}")
    return out
