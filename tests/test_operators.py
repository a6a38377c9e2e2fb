from collections import Counter

import random
import statistics

from pyspark.sql import functions as F

from tariffscope.operators import audit, marts, payers, quality, sketches
from tariffscope.operators.lookup import lookup_join
from tariffscope.operators.medians import group_with_medians, weighted_medians
from tariffscope.session import materialize
from tariffscope.sources import seeds


def expand(rows, column):
    return [r[column] for r in rows for _ in range(r["n"]) if r[column] is not None]


def test_weighted_medians_match_the_definition_on_skewed_groups(spark):
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        group = None if i % 50 == 0 else "hot" if i % 3 else f"g{i % 17}"
        v = rng.choice([0.0, -5.25, 100.0, round(rng.lognormvariate(5, 3), 2), -round(rng.random(), 3)])
        rows.append({"k": group, "v": v, "w": None if i % 4 else rng.random() * 1e6, "n": rng.randint(1, 4)})
    points = materialize(spark.createDataFrame(rows, "k string, v double, w double, n long"), "points")
    want = {}
    for group in {r["k"] for r in rows}:
        mine = [r for r in rows if r["k"] == group]
        v, w = expand(mine, "v"), expand(mine, "w")
        want[group] = (statistics.median(v), statistics.median(w) if w else None)

    def got(df):
        return {r.k: (r.v, r.w) for r in df.select("k", "v", "w").collect()}

    columns = {"v": "v", "w": "w"}
    spread = got(weighted_medians(points, ["k"], ["v", "w"], "n"))
    for medians in (spread, got(group_with_medians(points, ["k"], columns, "n")),
                    got(group_with_medians(points, ["k"], columns, "n", max_values=1))):
        assert medians.keys() == want.keys()
        for group, (v, w) in want.items():
            assert abs(medians[group][0] - v) < 1e-9
            assert (medians[group][1] is None) == (w is None)
            assert w is None or abs(medians[group][1] - w) < 1e-6


def test_lookup_join_gives_the_same_rows_on_every_path(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 40}", None if i % 5 else "p") for i in range(900)],
                                  "i int, a string, b string")
    lookup = facts.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("i").alias("v")).where("a <> 'k3'")
    lookup = materialize(lookup, "lookup")
    for how in ("inner", "left"):
        results = [
            sorted(map(tuple, lookup_join(facts, lookup, ["a", "b"], "n", nullable=["b"], how=how, **o).collect()))
            for o in ({}, {"max_rows": 5}, {"max_rows": 5, "hot_rows": 10})
        ]
        assert results[0] == results[1] == results[2]
        assert len(results[0]) == facts.count() if how == "left" else len(results[0]) < facts.count()


def pairs(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "payer_name string, plan_name string, n_rows long")


def test_payer_dimension(spark):
    rows = [
        ("AARP UHC MEDICARE COMPLETE [1203]", "HB MEDICARE - NO IME"),
        ("ZZZTUFTS AETNA [9]", None),
        ("FALLON", "FALLON COMMERCIAL (130% OF MEDICARE)"),
        ("Optum", "VA Government"),
        ("Unknown Fund", "Cigna PPO"),
        ("Unknown Fund", None),
        ("MEDICARE", "A"),
        ("WELLSENSE ACO", "x"),
        ("Summit PACE", None),
    ]
    dim = payers.payer_dimension(pairs(spark, rows), seeds.payer_patterns(spark))
    got = {(r.payer_name, r.plan_name): r for r in dim.collect()}
    assert len(got) == len(rows)

    def look(i):
        r = got[rows[i]]
        return r.payer_display_name, r.is_retired_payer, r.payer_group, r.match_source, r.product_line

    assert look(0) == ("AARP UHC MEDICARE COMPLETE", False, "UnitedHealthcare", 1, "Medicare Advantage")
    # equal priority and length: the pattern text decides, always the same way
    assert look(1) == ("TUFTS AETNA", True, "Aetna", 1, "Commercial")
    assert look(2) == ("FALLON", False, "Fallon Health", 1, "Commercial")
    assert look(3) == ("Optum", False, "UnitedHealthcare", 1, "Other government")
    assert look(4) == ("Unknown Fund", False, "Cigna", 2, "Commercial")
    assert look(5) == ("Unknown Fund", False, "Other", None, "Commercial")
    assert look(6) == ("MEDICARE", False, "Medicare (traditional)", 1, "Medicare (traditional)")
    assert look(7)[2:] == ("WellSense Health Plan", 1, "Medicaid")
    assert look(8)[2:] == ("PACE / elder service plans", 1, "Other government")


def test_best_match_is_the_top_candidate(spark):
    cleansed = payers.cleanse(pairs(spark, [("BCBS MEDICARE", "AETNA"), ("X", "Tufts / Harvard Pilgrim"), ("Y", "Z")]))
    patterns = seeds.payer_patterns(spark)
    listed = payers.candidates(cleansed, patterns).collect()
    best = {r.payer_name: (r.matched_group, r.match_source) for r in payers.best_match(cleansed, patterns).collect()}
    for name, (group, source) in best.items():
        mine = [c for c in listed if c.payer_name == name]
        if not mine:
            assert (group, source) == (None, None)
            continue
        top = min(mine, key=lambda c: (c.match_source, c.priority, -c.specificity, c.pattern))
        assert (group, source) == (top.payer_group, top.match_source)


def test_many_patterns_and_odd_ones(spark):
    """50,000 patterns; wildcards alone, escapes, short pieces, one sign; against trying every pattern."""
    import re

    odd = ["%", "_%", "%a_tna%", "a%", r"50\%%", r"%x\_y%", "%bc%", "q", "", "%--%", r"%\\%", "%é%"]
    many = [f"%carrier {i:05d}%" for i in range(50_000)]
    rows = [(p, f"g{i}", i % 7, None) for i, p in enumerate(odd + many)]
    patterns = spark.createDataFrame(rows, "pattern string, payer_group string, priority int, product_line string")
    texts = ["Aetna", "AXTNA", "50% off", "x_y", "xzy", "q", "", "abc -- d", "back\\slash", "the carrier 04711 plan", "CARRIER 49999", "é", "Zz"]
    cleansed = payers.cleanse(pairs(spark, [(t, texts[-i]) for i, t in enumerate(texts)]))
    got = Counter((r.payer_name, r.match_source, r.pattern) for r in payers.candidates(cleansed, patterns).collect())

    def matches(text, pattern):
        parts = re.findall(r"\\.|.", pattern)
        regex = "".join(".*" if x == "%" else "." if x == "_" else re.escape(x[-1]) for x in parts)
        return re.fullmatch(regex, text, re.S) is not None

    short = odd + [many[4711], many[49999]]
    want = Counter()
    for i, name in enumerate(texts):
        for source, text in ((1, name.lower()), (2, texts[-i].lower())):
            want.update((name, source, p) for p in short if matches(text, p))
    assert got == want
    best = {r.payer_name: r.matched_group for r in payers.best_match(cleansed, patterns).collect()}
    top = {t: min((s, (odd + many).index(p) % 7, -len(p), p) for n, s, p in want if n == t) for t in texts}
    assert best == {t: f"g{(odd + many).index(p)}" for t, (*_, p) in top.items()}


def price_row(hospital, group, line, rate, service="MRI"):
    return ("Imaging", service, "70551", hospital, group, line, rate)


def test_benchmark_and_dispersion(spark):
    rows = [
        price_row("H1", "Aetna", "Commercial", 300.0),
        price_row("H1", "Cigna", "Commercial", 500.0),
        price_row("H1", "Medicare (traditional)", "Medicare (traditional)", 200.0),
        price_row("H2", "Aetna", "Commercial", 400.0),
        price_row("H3", "Aetna", "Commercial", 800.0),
        price_row("H4", "Aetna", "Medicaid", 1.0),
    ]
    prices = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in marts.GRAIN) + ", median_rate double")
    for c in set(marts.MART_COLUMNS) - set(prices.columns) - {"pct_of_medicare"}:
        prices = prices.withColumn(c, F.lit(None).cast("double"))
    pct = {(r.hospital_name, r.payer_group): r.pct_of_medicare for r in marts.with_benchmark(prices).collect()}
    assert pct[("H1", "Aetna")] == 150.0 and pct[("H1", "Cigna")] == 250.0 and pct[("H2", "Aetna")] is None

    (row,) = marts.mart_price_dispersion(prices).collect()
    assert (row.hospitals, row.lowest_hospital_median, row.highest_hospital_median) == (3, 400.0, 800.0)
    assert (row.lowest_hospital, row.highest_hospital, row.high_to_low_ratio) == ("H1", "H3", 2.0)


def test_multiset_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert sorted(map(tuple, quality.same_rows(a, b).collect())) == [(1, "left"), (3, "right")]
    assert quality.same_rows(a, a).isEmpty()


def test_sketches_merge_within_their_error(spark):
    """50,000 values a group, far more than a sketch holds; some hospitals and groups without values."""
    rows = spark.range(100_000).select(
        (F.col("id") % 7).alias("hospital_id"), (F.col("id") % 2).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("effective_rate"),
        F.when((F.col("id") % 7 == 0) & (F.col("id") % 2 == 0), F.lit(3.0)).alias("median_amount"),
    )
    stored = sketches.rate_sketches(rows, ["hospital_id", "g"])
    found = sketches.merged_medians(stored, ["g"]).collect()
    assert {(r.g, r.n_effective_rate, r.median_actually_paid) for r in found} == {(0, 50_000, 3.0), (1, 50_000, None)}
    estimates = spark.createDataFrame([(r.g, r.median_rate) for r in found], "g bigint, e double")
    for r in sketches.ranks_of(rows, estimates, ["g"], "effective_rate", "e").collect():
        assert r.below <= 0.5 + 2 * sketches.rank_error() and r.upto >= 0.5 - 2 * sketches.rank_error()
    assert sketches.merged_medians(stored.limit(0), ["g"]).collect() == []


def test_layouts_are_compared_by_counts(spark):
    a, b, c = (spark.createDataFrame([(x,) for x in rows], "x int") for rows in ([1, 1, 2, 4], [1, 2, 3, 4], [1, 1, 2, None, 4]))
    got = {r.x: (r.a, r.b, r.c) for r in quality.layout_differences({"a": a, "b": b, "c": c}).collect()}
    assert got == {1: (2, 1, 2), 3: (0, 1, 0), None: (0, 0, 1)}


def test_only_errors_stop_a_job():
    import pytest

    audit.demand([("w", "warn", 2), ("f", "error", 0)])
    with pytest.raises(quality.ExpectationError, match="broken: 2"):
        audit.demand([("w", "warn", 2), ("broken", "error", 2)])
