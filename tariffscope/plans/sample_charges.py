"""Charges and hospital records derived from the order tables, for the registered queries.

A line item becomes a charge row, a part an item, a customer's segment and nation a payer, a nation
a hospital. The values are chosen so that every rule has work to do: padded names, codes under
the wrong label, retired and unknown payers, percentage and formula rates, missing list prices.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffscope import schema
from tariffscope.sources import seeds

# Fixed values shared with the reference SQL.
SEGMENT_PAYERS = {
    "AUTOMOBILE": "AETNA",
    "BUILDING": "BCBS MA",
    "FURNITURE": " UHC MEDICARE COMPLETE",
    "HOUSEHOLD": "Fallon",
    "MACHINERY": "Machinery Fund",
}
PRIORITY_PLANS = {
    "1-URGENT": "COMMERCIAL PPO (130% OF MEDICARE)",
    "2-HIGH": "MEDICARE - NO IME",
    "3-MEDIUM": "HMO ",
    "4-NOT SPECIFIED": "VA CCN",
}
SETTINGS = {"A": "Inpatient", "N": " outpatient"}
FLAGS = [*SETTINGS, "R"]
METHODS = ["Fee Schedule", "case rate", "percent of total billed charges"]
CODE_SPACE = 40


def item_codes() -> list[tuple[str, str]]:
    """The code of an item by part number modulo CODE_SPACE: every service, then unlisted codes."""
    codes = [(s["billing_code"], s["code_type"]) for s in seeds.service_rows()]
    codes = [(c.zfill(4) if t == "MS-DRG" else c, t) for c, t in codes]
    codes += [(f"j{1000 + i}", "HCPCS") for i in range(len(codes), CODE_SPACE - 1)]
    return [*codes, ("000", "MS-DRG")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: Column, mapping: dict, default: Column) -> Column:
    out = None
    for value, result in mapping.items():
        hit = column == value
        out = F.when(hit, result) if out is None else out.when(hit, result)
    return out.otherwise(default)


def _place(column: Column, values: list[str]) -> Column:
    """The place of a text in a list, its length for any other text; a number takes less room in a shuffle."""
    return _choose(column, {v: F.lit(i) for i, v in enumerate(values)}, F.when(column.isNotNull(), len(values))).cast("int")


def _packed(number: Column, places: list[tuple[Column, int]]) -> Column:
    """One long that holds an int and small values from 0 below a given count, any of which may be NULL."""
    high = F.when(number.isNull(), 1).otherwise(0).cast("bigint")
    for value, count in places:
        high = high * (count + 1) + F.coalesce(value, F.lit(count))
    return F.shiftleft(high, 32).bitwiseOR(F.coalesce(number, F.lit(0)).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))


def _unpacked(packed: Column, counts: list[int]) -> list[Column]:
    """The int and the small values of ``_packed``."""
    high, low = F.shiftright(packed, 32), packed.bitwiseAND(F.lit(0xFFFFFFFF))
    values = []
    for count in reversed(counts):
        place = high % (count + 1)
        values.append(F.when(place < count, place).cast("int"))
        high = F.floor(high / (count + 1))
    number = F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low).cast("int")
    return [F.when(high == 0, number), *reversed(values)]


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long charges table (schema.CHARGES plus hospital_id).

    Lines are spread by the key of their first join, so a file with few row groups still uses
    every core and a large one is shuffled no more often than the join needs. Their small values travel in one number,
    as do those of an order.
    """
    # the remainder has the sign of the key
    small = [(F.col("l_suppkey") % 5 + 4, 9), (F.col("l_tax") > 0.04, 2), (_place(F.col("l_returnflag"), FLAGS), len(FLAGS) + 1), (F.col("l_linestatus") != "F", 2)]
    small = [(value.cast("bigint"), count) for value, count in small]
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", _packed(F.col("l_linenumber"), small).alias("line"),
    ).repartition("l_orderkey")
    plan, segment = _place(F.col("o_orderpriority"), [*PRIORITY_PLANS]), _place(F.col("c_mktsegment"), [*SEGMENT_PAYERS])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", plan.alias("plan"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", segment.alias("segment"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    # the customer of an order is found before its lines are, so that lines are shuffled once less
    payers = [(F.col("plan").cast("bigint"), len(PRIORITY_PLANS) + 1), (F.col("segment").cast("bigint"), len(SEGMENT_PAYERS) + 1)]
    orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", _packed(F.col("c_nationkey"), payers).alias("payer"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    number, supplier, taxed, flag, unfilled = _unpacked(F.col("line"), [count for _, count in small])
    nation, plan, segment = _unpacked(F.col("payer"), [count for _, count in payers])
    rows = rows.select(
        "p_partkey", "p_name", "p_retailprice", "l_quantity", "l_extendedprice", "l_discount", number.alias("l_linenumber"), (supplier - 4).alias("hospital"),
        (taxed == 1).alias("taxed"), flag.alias("flag"), (unfilled == 1).alias("unfilled"), nation.alias("c_nationkey"), plan.alias("plan"), segment.alias("segment"),
    )

    line, part, nation = F.col("l_linenumber"), F.col("p_partkey"), F.col("c_nationkey")
    known = F.from_json(
        F.lit(json.dumps([{"code": c, "type": t} for c, t in item_codes()])), schema.CODES.simpleString()
    )
    code = F.get(known, (part % CODE_SPACE).cast("int"))
    relabelled = F.struct(
        code["code"].alias("code"),
        F.when((part % 3 == 0) & (code["type"] == "CPT"), "HCPCS").otherwise(code["type"]).alias("type"),
    )
    revenue = F.struct(
        F.concat(F.lit("0"), (300 + part % 9).cast("string")).alias("code"), F.lit("RC").alias("type")
    )
    codes = F.when(part % 11 == 5, F.array().cast(schema.CODES)).otherwise(F.array(revenue, relabelled))

    payer = (
        F.when(nation == 3, "MEDICARE")
        .when(nation == 5, "MassHealth")
        .otherwise(_choose(F.col("segment"), dict(enumerate(SEGMENT_PAYERS.values())), F.lit(None)))
    )
    retired = F.when(nation % 7 == 0, "ZZZ").otherwise("")
    payer_name = F.concat(retired, payer, F.lit(" ["), (1200 + nation).cast("string"), F.lit("]"))
    rate = F.col("l_extendedprice") / F.col("l_quantity")
    formula = (line == 5) & (F.col("flag") == FLAGS.index("R"))
    paid = F.when(F.col("taxed"), rate * 0.9)
    percent_row = line % 4 == 0

    return rows.select(
        F.when(part % 97 != 0, F.concat(F.lit(" "), "p_name", F.lit(" #"), part.cast("string"))).alias("description"),
        codes.alias("codes"),
        _choose(F.col("flag"), dict(enumerate(SETTINGS.values())), F.lit("both")).alias("setting"),
        F.when(F.col("unfilled"), "50").alias("modifiers"),
        F.when(part % 13 == 2, "10.5").alias("drug_unit"),
        F.when(part % 13 == 2, "ML").alias("drug_unit_type"),
        F.when(line.isin(1, 7), F.col("p_retailprice") * 3).alias("gross_charge"),
        F.when(line == 7, F.col("p_retailprice") * 2).alias("discounted_cash"),
        F.col("p_retailprice").alias("min_charge"),
        (F.col("p_retailprice") * 4).alias("max_charge"),
        F.when(line < 6, payer_name).alias("payer_name"),
        F.when(line < 6, _choose(F.col("plan"), dict(enumerate(PRIORITY_PLANS.values())), F.lit(None))).alias("plan_name"),
        F.when((line < 6) & ~percent_row & ~formula, rate).alias("negotiated_dollar"),
        F.when((line < 6) & percent_row, F.col("l_discount") * 1000).alias("negotiated_percentage"),
        F.when((line < 6) & (formula | percent_row), "per contract, see exhibit").alias("negotiated_algorithm"),
        F.when(line < 6, _choose(line % 3, dict(enumerate(METHODS)), F.lit(None))).alias("methodology"),
        F.when(line < 6, paid).alias("median_amount"),
        F.when(line < 6, paid * 0.5).alias("p10_amount"),
        F.when(line < 6, paid * 1.5).alias("p90_amount"),
        F.when((line < 6) & paid.isNotNull(), F.col("l_quantity").cast("int").cast("string")).alias("allowed_count"),
        F.when((line < 6) & (formula | percent_row), rate * 0.75).alias("estimated_amount"),
        F.when(line == 2, F.concat(F.lit('Size 9" x 1", see "'), "p_name", F.lit('"'))).alias("notes"),
        F.concat(F.lit("h"), F.col("hospital").cast("string")).alias("hospital_id"),
    )


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata record per nation; only the first five have charges."""
    nation, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    text = key.cast("string")
    npi = F.array(F.concat(F.lit("100000"), F.lpad(text, 4, "0")), F.concat(F.lit("200000"), F.lpad(text, 4, "0")))
    values = {
        "hospital_id": F.concat(F.lit("h"), text),
        "hospital_name": F.concat("n_name", F.lit(" Hospital")),
        "last_updated_on": F.when(key % 3 == 0, F.concat(F.lit("7/"), (1 + key).cast("string"), F.lit("/2026")))
        .when(key % 3 == 1, F.concat(F.lit("2026-04-"), F.lpad((1 + key).cast("string"), 2, "0")))
        .otherwise("soon"),
        "version": F.lit("3.0.0"),
        "location_name": F.array("n_name"),
        "type_2_npi": F.when(key % 4 != 3, npi),
        "license_number": text,
        "license_state": F.lit("CA"),
        "attestation_confirmed": key % 2 == 0,
        "source_file": F.concat("n_name", F.lit(".csv")),
        "source_format": F.when(key % 2 == 0, "csv_tall").otherwise("json"),
        "row_count": key.cast("long") * 100,
        "parsed_at": F.lit("2026-09-27T17:07:51+00:00"),
    }
    return nation.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.HOSPITALS]
    )
