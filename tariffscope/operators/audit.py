"""Expectations checked while tables are written, before anything is published.

Rules on single rows are counted in the pass that writes the table (or reads it for the first time), by metrics
observed on the way. Rules on keys - unique, known to the parent, covered - come from one aggregate over all keys. Only when
a rule is broken is its table read again, to store the offending rows with the severity.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tariffscope.operators import quality
from tariffscope.operators.compare import PRODUCT_LINES
from tariffscope.session import materialize

ERROR, WARN = "error", "warn"


def _outside(column: str, values: list[str]) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"{column} NOT IN ({listed})"


@dataclass(frozen=True)
class RowRule:
    """A rule a row breaks on its own; ``broken`` is a condition, NULL means not judged."""

    table: str
    name: str
    severity: str
    broken: str


#: Rules on the rows of each table.
ROW_RULES = (
    RowRule("charges", "charges.hospital_id not null", ERROR, "hospital_id IS NULL"),
    RowRule("charges", "charges.setting accepted", WARN, _outside("setting", quality.SETTINGS)),
    RowRule("hospitals", "hospitals.hospital_id not null", ERROR, "hospital_id IS NULL"),
    RowRule("payers", "payers.payer_key not null", ERROR, "payer_key IS NULL"),
    RowRule("payers", "payers.payer_group not null", ERROR, "payer_group IS NULL"),
    RowRule("payers", "payers.product_line accepted", ERROR, _outside("product_line", PRODUCT_LINES)),
    RowRule("services", "services.billing_code not null", ERROR, "billing_code IS NULL"),
    RowRule("rates", "rates.rate_key not null", ERROR, "rate_key IS NULL"),
    RowRule("rates", "rates.effective_rate not negative", ERROR, "effective_rate < 0"),
    RowRule(
        "rates", "rate above list price", WARN,
        f"methodology = 'fee schedule' AND effective_rate > gross_charge * {quality.ABOVE_LIST}D",
    ),
)
#: Rules on keys: the table whose key it is, the key, and how many rows of children and of parents are wrong.
KEY_RULES = (
    ("hospitals.hospital_id unique", ERROR, "hospital_id", "parents > 1"),
    ("payers.payer_key unique", ERROR, "payer_key", "parents > 1"),
    ("rates.rate_key unique", WARN, "rate_key", "rows > 1"),
    ("rates.hospital_id known", ERROR, "hospital_id", "rows > 0 AND parents = 0"),
    ("rates.payer_key known", ERROR, "payer_key", "rows > 0 AND parents = 0"),
)
COVERAGE, UNMAPPED = "hospital service coverage", "unmapped payers"
SEVERITY = {r.name: r.severity for r in ROW_RULES} | {n: s for n, s, *_ in KEY_RULES} | {COVERAGE: WARN, UNMAPPED: WARN}

OFFENDERS = "rule string, severity string, rows bigint, offender string"


class Watch:
    """Counts broken row rules of the tables it is shown, in the pass that next reads or writes them."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[DataFrame, Observation]] = {}

    def watch(self, table: str, df: DataFrame) -> DataFrame:
        rules = [r for r in ROW_RULES if r.table == table]
        observation = Observation(f"audit_{table}")
        self._seen[table] = (df, observation)
        return df.observe(observation, *[F.count_if(F.expr(r.broken)).alias(r.name) for r in rules])

    def offenders(self, stored: dict[str, DataFrame]) -> list[DataFrame]:
        """Rows of tables in which a rule was seen broken, read from where they are stored if they are."""
        out = []
        for table, (df, observation) in self._seen.items():
            counts = observation.get
            broken = [r for r in ROW_RULES if r.table == table and counts[r.name]]
            if broken:
                out.append(row_offenders(stored.get(table, df), broken))
        return out


def row_offenders(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """One row for each offending row and rule, in one pass for all rules."""
    hits = F.array_compact(F.array(*[F.when(F.expr(r.broken), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"))) for r in rules]))
    row = F.to_json(F.struct(*df.columns)).alias("offender")
    return df.select(F.explode(hits).alias("hit"), row).select("hit.rule", "hit.severity", F.lit(1).cast("bigint").alias("rows"), "offender")


def _short(key: str) -> str:
    """A text as bytes behind a sign for their kind: lower-case hex digits, as of digests, go two in a byte."""
    return f"CASE WHEN {key} = lower(hex(unhex({key}))) THEN concat(X'01', unhex({key})) ELSE concat(X'00', CAST({key} AS BINARY)) END"


def _long(key: str) -> str:
    """The text that ``_short`` was made of."""
    rest = f"substring({key}, 2)"
    return f"CASE WHEN substring({key}, 1, 1) = X'01' THEN lower(hex({rest})) ELSE CAST({rest} AS STRING) END"


def key_table(fact: DataFrame, hospitals: DataFrame, payers: DataFrame) -> DataFrame:
    """Keys with their number of rows in the fact and of parents (domain, key, code, rows, parents): one aggregate.

    Counts are combined before the shuffle, so a hot key costs no more than others. Rate keys that occur once are left out.
    """

    def entry(domain: str, key: str, code: str = "NULL", when: str = "TRUE") -> str:
        fields = f"'{domain}' AS domain, {_short(f'CAST({key} AS STRING)')} AS key, CAST({code} AS STRING) AS code"
        return f"CASE WHEN {key} IS NOT NULL AND {when} THEN struct({fields}) END"

    entries = [entry("rate_key", "rate_key"), entry("hospital_id", "hospital_id"), entry("payer_key", "payer_key")]
    entries.append(entry("covered", "hospital_id", "billing_code", "is_shoppable"))
    children = fact.select(F.inline(F.expr(f"array_compact(array({', '.join(entries)}))")), F.lit(1).alias("_row"), F.lit(0).alias("_parent"))
    parents = [
        df.where(f"{key} is not null").select(
            F.lit(key).alias("domain"), F.expr(_short(f"CAST({key} AS STRING)")).alias("key"), F.lit(None).cast("string").alias("code"), F.lit(0).alias("_row"), F.lit(1).alias("_parent")
        )
        for df, key in ((hospitals, "hospital_id"), (payers, "payer_key"))
    ]
    counted = reduce(DataFrame.unionByName, parents, children).groupBy("domain", "key", "code").agg(
        F.sum("_row").alias("rows"), F.sum("_parent").alias("parents")
    )
    return counted.where("domain <> 'rate_key' or rows > 1").withColumn("key", F.expr(_long("key")))


def key_offenders(keys: DataFrame, hospitals: DataFrame, payers: DataFrame, services: DataFrame) -> list[DataFrame]:
    """Keys that break a rule, from the key table."""

    def told(df: DataFrame, rule: str, n: str, *fields: str) -> DataFrame:
        return df.select(
            F.lit(rule).alias("rule"), F.lit(SEVERITY[rule]).alias("severity"), F.col(n).cast("bigint").alias("rows"), F.to_json(F.struct(*fields)).alias("offender")
        )

    out = [
        told(keys.where((F.col("domain") == domain) & F.expr(broken)).withColumnRenamed("key", domain), name, "parents" if "parents >" in broken else "rows", domain)
        for name, _, domain, broken in KEY_RULES
    ]
    covered = keys.where("domain = 'covered'").select(F.col("key").alias("hospital_id"), F.col("code").alias("billing_code"), F.lit(True).alias("is_shoppable"))
    low = quality.low_coverage(hospitals, covered, services)
    out.append(told(low, COVERAGE, "shoppable_services_found", "hospital_id", "shoppable_services_found", "shoppable_services_total"))
    used = keys.where("domain = 'payer_key'").select(F.col("key").alias("payer_key"), F.col("rows").alias("rates"))
    unmapped = payers.where("payer_group = 'Other'").join(used.where("rates > 0"), "payer_key").groupBy("payer_name", "plan_name")
    out.append(told(unmapped.agg(F.sum("rates").alias("rates")), UNMAPPED, "rates", "payer_name", "plan_name"))
    return out


def audit(watch: Watch, tables: dict[str, DataFrame]) -> DataFrame:
    """All offenders (rule, severity, rows, offender) of written tables hospitals, payers, services and rates."""
    hospitals, payers = tables["hospitals"], tables["payers"]
    keys = materialize(key_table(tables["rates"], hospitals, payers), "audit_keys")
    found = [*watch.offenders(tables), *key_offenders(keys, hospitals, payers, tables["services"])]
    return reduce(DataFrame.unionByName, found)


def findings(offenders: DataFrame) -> list[tuple[str, str, int]]:
    """Every rule with its severity and its number of offenders."""
    counts = {r.rule: r.n for r in offenders.groupBy("rule").agg(F.count("*").alias("n")).collect()}
    return [(name, severity, counts.get(name, 0)) for name, severity in SEVERITY.items()]


def demand(found: list[tuple[str, str, int]]) -> None:
    """Raise when a rule of severity ``error`` is broken."""
    if broken := [f"{name}: {n}" for name, severity, n in found if severity == ERROR and n]:
        raise quality.ExpectationError("; ".join(broken))


