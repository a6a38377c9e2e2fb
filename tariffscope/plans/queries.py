"""The registered queries: name -> (DataFrame builder, reference SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffscope.operators import audit, compare, marts, payers, prices, quality, rates, sketches
from tariffscope.plans import oracle, sample_charges, staging
from tariffscope.session import configure, materialize
from tariffscope.sources import seeds

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        _REGISTRY[name] = (lambda spark, sf_dir: fn(configure(spark), sf_dir), sql)
        return fn

    return keep


class Model:
    """The transform over the derived charges; every part is built on demand.

    Parts that read the charges several times start from a written table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.staged = staging.stage_charges(sample_charges.charges(spark, sf_dir))
        self.coded = staging.with_billing_code(self.staged)

    @cached_property
    def patterns(self) -> DataFrame:
        return seeds.payer_patterns(self.spark)

    @cached_property
    def services(self) -> DataFrame:
        return staging.dim_service(seeds.shoppable_services(self.spark))

    @cached_property
    def hospitals(self) -> DataFrame:
        return staging.dim_hospital(staging.stage_hospitals(sample_charges.hospitals(self.spark, self.sf_dir)))

    @cached_property
    def stored(self) -> DataFrame:
        return materialize(self.staged, "staged_charges")

    @cached_property
    def payers(self) -> DataFrame:
        return rates.build_payers(self.stored, self.patterns)

    def fact(self, shoppable_only: bool = False) -> DataFrame:
        coded = staging.with_billing_code(self.stored)
        listed = rates.build_prices(coded)
        return rates.negotiated_rates(coded, self.payers, listed, self.services, shoppable_only)

    def rates(self) -> DataFrame:
        return marts.service_rates(self.fact(shoppable_only=True), self.services, self.hospitals, self.payers)

    def mart(self) -> DataFrame:
        points = materialize(marts.rate_points(self.rates()), "rate_points")
        return marts.service_prices(points)


# ---- staging and codes -------------------------------------------------------------------------

_NO_CODES = "* EXCLUDE (codes)"


@register("stage_charges", oracle.sql(f"SELECT {_NO_CODES}, len(codes) AS n_codes FROM staged", "staged"))
def _(spark, sf):
    staged = Model(spark, sf).staged
    return staged.withColumn("n_codes", F.size("codes").cast("long")).drop("codes")


@register("stage_hospitals", oracle.whole("hospitals"))
def _(spark, sf):
    return staging.stage_hospitals(sample_charges.hospitals(spark, sf)).withColumn(
        "parsed_at", F.col("parsed_at").cast("timestamp_ntz")
    )


@register("primary_billing_code", oracle.whole("coded", "hospital_id, description, billing_code, billing_code_type"))
def _(spark, sf):
    return Model(spark, sf).coded.select("hospital_id", "description", "billing_code", "billing_code_type")


@register("code_signature", oracle.whole("coded", "hospital_id, description, code_signature"))
def _(spark, sf):
    return Model(spark, sf).coded.select("hospital_id", "description", "code_signature")


# ---- payers ------------------------------------------------------------------------------------


@register("payer_cleanse", oracle.whole("cleansed"))
def _(spark, sf):
    return payers.cleanse(payers.payer_pairs(Model(spark, sf).staged)).drop("n_rows")


@register("payer_candidates", oracle.whole("candidates"))
def _(spark, sf):
    model = Model(spark, sf)
    return payers.candidates(payers.cleanse(payers.payer_pairs(model.staged)), model.patterns)


@register(
    "payer_best_match",
    oracle.sql(
        """SELECT c.payer_name, c.plan_name, b.payer_group AS matched_group, b.product_line_override, b.match_source
        FROM cleansed c LEFT JOIN best b ON c.payer_name = b.payer_name
        AND c.plan_name IS NOT DISTINCT FROM b.plan_name""",
        "cleansed",
        "best",
    ),
)
def _(spark, sf):
    model = Model(spark, sf)
    return payers.best_match(payers.cleanse(payers.payer_pairs(model.staged)), model.patterns).select(
        "payer_name", "plan_name", "matched_group", "product_line_override", "match_source"
    )


@register("payer_dimension", oracle.whole("payers"))
def _(spark, sf):
    model = Model(spark, sf)
    return payers.payer_dimension(payers.payer_pairs(model.staged), model.patterns).drop("n_rows")


# ---- list prices and the fact ------------------------------------------------------------------


@register("item_list_price", oracle.whole("item_prices"))
def _(spark, sf):
    return prices.item_prices(prices.price_points(Model(spark, sf).coded))


@register("item_list_price_any_setting", oracle.whole("item_prices_any"))
def _(spark, sf):
    return prices.item_prices_any_setting(prices.price_points(Model(spark, sf).coded))


@register("code_list_price", oracle.whole("code_prices"))
def _(spark, sf):
    points = materialize(prices.price_points(Model(spark, sf).coded), "price_points")
    return prices.code_prices(points).drop("n_points")


@register("fact_rates", oracle.whole("fact"))
def _(spark, sf):
    return Model(spark, sf).fact()


@register(
    "list_price_match_counts", oracle.sql("SELECT list_price_match, count(*) AS n FROM fact GROUP BY ALL", "fact")
)
def _(spark, sf):
    return Model(spark, sf).fact().groupBy("list_price_match").agg(F.count("*").alias("n"))


@register("rate_source_counts", oracle.sql("SELECT rate_source, count(*) AS n FROM fact GROUP BY ALL", "fact"))
def _(spark, sf):
    return Model(spark, sf).fact().groupBy("rate_source").agg(F.count("*").alias("n"))


# ---- marts -------------------------------------------------------------------------------------


@register("service_prices", oracle.whole("mart"))
def _(spark, sf):
    return Model(spark, sf).mart()


@register("pct_of_medicare", oracle.whole("benchmarked"))
def _(spark, sf):
    return marts.with_benchmark(Model(spark, sf).mart())


@register("price_dispersion", oracle.whole("dispersion"))
def price_dispersion(spark, sf):
    return marts.mart_price_dispersion(Model(spark, sf).mart())


@register(
    "top12_dispersion",
    oracle.sql("SELECT * FROM dispersion ORDER BY high_to_low_ratio DESC NULLS LAST, billing_code LIMIT 12", "dispersion"),
)
def _(spark, sf):
    return compare.top_dispersion(marts.mart_price_dispersion(Model(spark, sf).mart()))


@register(
    "approx_median_prices",
    oracle.sql(
        """SELECT category, service_name, billing_code, hospital_name, payer_group, product_line,
        count(*) AS plan_rates, quantile_disc(effective_rate, 0.5) AS median_rate,
        quantile_disc(median_amount, 0.5) AS median_actually_paid FROM rates GROUP BY ALL""",
        "rates",
    ),
)
def _(spark, sf):
    """The sketch is exact below its accuracy, where it returns the lower middle value."""
    return marts.approx_prices(Model(spark, sf).rates())


# ---- comparison views --------------------------------------------------------------------------


@register("service_selection", oracle.sql(
    "SELECT * FROM mart WHERE billing_code = '70551' AND product_line = 'Commercial'", "mart"))
def _(spark, sf):
    return compare.selection(Model(spark, sf).mart(), "70551", marts.COMMERCIAL)


@register("hospital_summary", oracle.whole("summary"))
def _(spark, sf):
    return compare.hospital_summary(Model(spark, sf).mart())


@register(
    "service_spread",
    oracle.sql(
        """SELECT billing_code, product_line, count(*) AS hospitals,
        min(struct_pack(m := hospital_median, h := hospital_name)).h AS lowest_hospital,
        min(hospital_median) AS lowest_median,
        max(struct_pack(m := hospital_median, h := hospital_name)).h AS highest_hospital,
        max(hospital_median) AS highest_median,
        CASE WHEN count(*) > 1 THEN max(hospital_median) / nullif(min(hospital_median), 0) END AS spread
        FROM summary GROUP BY billing_code, product_line""",
        "summary",
    ),
)
def _(spark, sf):
    return compare.service_spread(Model(spark, sf).mart())


@register(
    "insurer_median",
    oracle.sql(
        """SELECT billing_code, product_line, median(median_rate) AS median_across_insurers, count(*) AS pairs
        FROM mart GROUP BY ALL""",
        "mart",
    ),
)
def _(spark, sf):
    return compare.insurer_median(Model(spark, sf).mart())


@register(
    "contract_type_compare",
    oracle.sql(
        """SELECT hospital_name, service_name, billing_code, contract_type, median(effective_rate) AS median_rate
        FROM (SELECT *, CASE WHEN is_percent THEN 'percentage of list price'
              WHEN methodology = 'fee schedule' THEN 'fee schedule' END AS contract_type
              FROM rates WHERE product_line = 'Commercial')
        WHERE contract_type IS NOT NULL GROUP BY ALL""",
        "rates",
    ),
)
def _(spark, sf):
    return compare.contract_types(Model(spark, sf).rates())


@register("service_list", oracle.sql("SELECT DISTINCT billing_code, category, service_name FROM mart", "mart"))
def _(spark, sf):
    return compare.service_list(Model(spark, sf).mart())


@register(
    "product_lines_present",
    oracle.sql(
        f"""SELECT CAST(i - 1 AS INTEGER) AS position, p AS product_line FROM (SELECT unnest({compare.PRODUCT_LINES!r}) AS p,
        generate_subscripts({compare.PRODUCT_LINES!r}, 1) AS i) WHERE p IN (SELECT product_line FROM mart)""",
        "mart",
    ),
)
def _(spark, sf):
    return compare.product_lines_present(Model(spark, sf).mart())


@register("export_prices", oracle.whole("benchmarked"))
def _(spark, sf):
    return compare.ordered_prices(marts.with_benchmark(Model(spark, sf).mart()))


@register(
    "export_hospitals",
    oracle.whole("hospitals", "hospital_name, CAST(last_updated_on AS VARCHAR) AS last_updated_on, schema_version, source_format"),
)
def _(spark, sf):
    return compare.ordered_hospitals(Model(spark, sf).hospitals)


@register("demo_flag", oracle.sql("SELECT bool_or(contains(hospital_name, 'FICTIONAL')) AS is_demo FROM hospitals", "hospitals"))
def _(spark, sf):
    return compare.is_demo(Model(spark, sf).hospitals)


@register("dim_hospital", oracle.whole("hospitals", """hospital_id, hospital_name, type_2_npi, last_updated_on, schema_version,
    source_format, source_row_count, attestation_confirmed, parsed_at"""))
def _(spark, sf):
    return Model(spark, sf).hospitals.withColumn("parsed_at", F.col("parsed_at").cast("timestamp_ntz"))


# ---- data quality ------------------------------------------------------------------------------


@register(
    "dq_unique", oracle.sql("SELECT rate_key, count(*) AS n FROM fact GROUP BY ALL HAVING count(*) > 1", "fact")
)
def _(spark, sf):
    return quality.duplicates(Model(spark, sf).fact(), "rate_key")


@register("dq_not_null", oracle.sql(f"SELECT {_NO_CODES} FROM coded WHERE billing_code IS NULL", "coded"))
def _(spark, sf):
    coded = Model(spark, sf).coded
    return quality.not_null(coded, "billing_code").drop("codes", "effective_rate", "rate_source")


@register(
    "dq_accepted",
    oracle.sql(
        """SELECT setting, count(*) AS n FROM charges WHERE setting NOT IN ('inpatient', 'outpatient', 'both')
        GROUP BY ALL""",
        "charges",
    ),
)
def _(spark, sf):
    return quality.not_accepted(sample_charges.charges(spark, sf), "setting", quality.SETTINGS)


@register(
    "dq_relationships",
    oracle.sql(
        """SELECT billing_code, count(*) AS n FROM fact WHERE billing_code IS NOT NULL
        AND billing_code NOT IN (SELECT billing_code FROM services) GROUP BY ALL""",
        "fact",
        "services",
    ),
)
def _(spark, sf):
    model = Model(spark, sf)
    return quality.orphans(model.fact(), model.services, "billing_code")


@register(
    "dq_non_negative",
    """SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal < 0""",
)
def _(spark, sf):
    accounts = sample_charges.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return quality.negative(accounts, "c_acctbal")


@register(
    "dq_rate_above_list",
    oracle.sql(
        """SELECT hospital_id, billing_code, description, payer_key, effective_rate, gross_charge FROM fact
        WHERE methodology = 'fee schedule' AND gross_charge > 0 AND effective_rate / gross_charge > 1.05""",
        "fact",
    ),
)
def _(spark, sf):
    return quality.rate_above_list(Model(spark, sf).fact())


@register(
    "dq_coverage",
    oracle.sql(
        """SELECT hospital_id, len(offered) AS shoppable_services_found, len(compared) AS shoppable_services_total
        FROM (SELECT hospital_id, list_intersect(coalesce(list(billing_code) FILTER (payer_name IS NOT NULL), []),
                  (SELECT list(billing_code) FROM services)) AS offered, (SELECT list(billing_code) FROM services) AS compared
              FROM hospitals LEFT JOIN (FROM coded SEMI JOIN services USING (billing_code, billing_code_type)) USING (hospital_id)
              GROUP BY hospital_id)
        WHERE 2 * len(offered) < len(compared)""",
        "hospitals",
        "coded",
        "services",
    ),
)
def _(spark, sf):
    model = Model(spark, sf)
    # coverage needs no prices: charges of compared services with a payer
    rated = model.coded.where("payer_name is not null")
    offered = rated.join(F.broadcast(model.services), ["billing_code", "billing_code_type"], "left_semi")
    return quality.low_coverage(model.hospitals, offered.withColumn("is_shoppable", F.lit(True)), model.services)


@register(
    "dq_unmapped_payers",
    oracle.sql(
        """SELECT payer_name, plan_name, count(*) AS rates FROM staged WHERE payer_name IS NOT NULL
        AND md5(payer_name || '|' || coalesce(plan_name, '')) IN (SELECT payer_key FROM payers WHERE payer_group = 'Other')
        GROUP BY payer_name, plan_name""",
        "staged",
        "payers",
    ),
)
def _(spark, sf):
    model = Model(spark, sf)
    return quality.unmapped_payers(model.fact(), model.payers)


@register(
    "sketch_medians",
    oracle.sql(
        """SELECT payer_group, CAST(count(effective_rate) AS BIGINT) AS rates, count(DISTINCT hospital_id) AS hospitals, true AS within_error
        FROM fact JOIN payers USING (payer_key) WHERE effective_rate IS NOT NULL GROUP BY payer_group""",
        "fact",
        "payers",
    ),
)
def _(spark, sf):
    """Medians by carrier from stored sketches of each hospital: is the rank of each within the stated error (twice, for all groups)?"""
    model, keys = Model(spark, sf), ["payer_group"]
    names = model.payers.select("payer_key", "payer_group")
    known = model.fact().where("effective_rate is not null").join(names, "payer_key")
    known = materialize(known.select("hospital_id", "payer_group", "effective_rate", "median_amount"), "rates")
    stored = materialize(sketches.rate_sketches(known, ["hospital_id", *keys]), "sketches")
    found = materialize(sketches.merged_medians(stored, keys), "medians")
    rank = sketches.ranks_of(known, found, keys, "effective_rate", "median_rate")
    allowed = 2 * sketches.rank_error()
    within = (F.col("below") <= 0.5 + allowed) & (F.col("upto") >= 0.5 - allowed)
    hospitals = stored.groupBy(*keys).agg(F.count("*").alias("hospitals"))
    return found.join(rank, keys).join(hospitals, keys).select(*keys, F.col("n_effective_rate").alias("rates"), "hospitals", within.alias("within_error"))


def _rule(rule: str, severity: str, rows: str, source: str) -> str:
    return f"SELECT '{rule}' AS rule, '{severity}' AS severity, count(*) AS offenders, CAST(sum({rows}) AS BIGINT) AS rows FROM {source}"


_PLANTED_RATES = """(SELECT * REPLACE (CASE WHEN description LIKE '%9' THEN -effective_rate ELSE effective_rate END AS effective_rate) FROM fact)"""
_PLANTED_HOSPITALS = """(FROM hospitals WHERE hospital_id <> 'h4' UNION ALL FROM hospitals WHERE hospital_id = 'h3')"""
_PLANTED_PAYERS = """(FROM payers WHERE payer_key >= '2' UNION ALL FROM payers WHERE payer_key >= 'e')"""
_PLANTED_STAGED = """(SELECT CASE WHEN description LIKE '%8' THEN 'elsewhere' ELSE setting END AS setting FROM staged)"""
_AUDIT_RULES = [
    _rule("charges.setting accepted", "warn", "1", f"{_PLANTED_STAGED} WHERE setting NOT IN ('inpatient', 'outpatient', 'both')"),
    _rule("hospitals.hospital_id unique", "error", "n", f"(SELECT count(*) AS n FROM {_PLANTED_HOSPITALS} GROUP BY hospital_id HAVING count(*) > 1)"),
    _rule("payers.payer_key unique", "error", "n", f"(SELECT count(*) AS n FROM {_PLANTED_PAYERS} GROUP BY payer_key HAVING count(*) > 1)"),
    _rule("rates.rate_key unique", "warn", "n", "(SELECT count(*) AS n FROM fact GROUP BY rate_key HAVING count(*) > 1)"),
    _rule("rates.hospital_id known", "error", "n", f"(SELECT count(*) AS n FROM fact ANTI JOIN {_PLANTED_HOSPITALS} USING (hospital_id) GROUP BY hospital_id)"),
    _rule("rates.payer_key known", "error", "n", f"(SELECT count(*) AS n FROM fact ANTI JOIN {_PLANTED_PAYERS} USING (payer_key) GROUP BY payer_key)"),
    _rule("rates.effective_rate not negative", "error", "1", f"{_PLANTED_RATES} WHERE effective_rate < 0"),
    _rule("rate above list price", "warn", "1", f"{_PLANTED_RATES} WHERE methodology = 'fee schedule' AND gross_charge > 0 AND effective_rate / gross_charge > 1.05"),
    _rule("hospital service coverage", "warn", "n", f"""(SELECT count(DISTINCT billing_code) AS n FROM {_PLANTED_HOSPITALS} h LEFT JOIN (SELECT hospital_id, billing_code
        FROM fact WHERE is_shoppable) USING (hospital_id) GROUP BY hospital_id HAVING 2 * count(DISTINCT billing_code) < (SELECT count(*) FROM services))"""),
    _rule("unmapped payers", "warn", "n", f"""(SELECT count(*) AS n FROM fact JOIN {_PLANTED_PAYERS} USING (payer_key)
        WHERE payer_group = 'Other' GROUP BY payer_name, plan_name)"""),
]


@register(
    "audit_offenders",
    oracle.sql(f"SELECT * FROM ({' UNION ALL '.join(_AUDIT_RULES)}) WHERE offenders > 0", "fact", "hospitals", "payers", "services", "staged"),
)
def _(spark, sf):
    """Every rule of the warehouse on tables in which breaks of most of them are planted."""
    model, watch = Model(spark, sf), audit.Watch()
    odd = F.when(F.col("description").like("%8"), "elsewhere").otherwise(F.col("setting"))
    watch.watch("charges", model.stored.withColumn("setting", odd)).write.format("noop").mode("overwrite").save()
    rate = F.when(F.col("description").like("%9"), -F.col("effective_rate")).otherwise(F.col("effective_rate"))
    hospitals, payers = model.hospitals, model.payers.drop("n_rows")
    planted = {
        "hospitals": hospitals.where("hospital_id <> 'h4'").unionByName(hospitals.where("hospital_id = 'h3'")),
        "payers": payers.where("payer_key >= '2'").unionByName(payers.where("payer_key >= 'e'")),
        "services": model.services,
        "rates": model.fact().withColumn("effective_rate", rate),
    }
    written = {name: materialize(watch.watch(name, df), name) for name, df in planted.items()}
    return audit.audit(watch, written).groupBy("rule", "severity").agg(F.count("*").alias("offenders"), F.sum("rows").alias("rows"))


def _load() -> None:
    """The ingest queries register themselves on import; they need ``register`` from here."""
    from tariffscope.plans import file_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return {name: fn for name, (fn, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql}
