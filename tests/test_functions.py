import datetime

from pyspark.sql import functions as F

from tariffscope import schema
from tariffscope.functions import codes as C
from tariffscope.functions import numbers as N
from tariffscope.functions import text as X
from tariffscope.functions.dates import flexible_date


def values(spark, rows, type_, fn):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {type_}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_money(spark):
    texts = ["$1,200.50", " 12 ", "", "  ", None, "n/a", "1d", "1_000", "1e3", "-.5", "NaN", "1\n"]
    assert values(spark, texts, "string", X.money) == [
        1200.5, 12.0, None, None, None, None, None, None, 1000.0, -0.5, None, None,
    ]


def test_dates(spark):
    texts = ["2026-07-01", "7/1/2026", "12/31/2025", "soon", None, "2026-13-01"]
    assert values(spark, texts, "string", flexible_date) == [
        datetime.date(2026, 7, 1), datetime.date(2026, 7, 1), datetime.date(2025, 12, 31), None, None, None,
    ]


def test_rounding_follows_the_double(spark):
    assert values(spark, [1.005, 2.5, -2.5], "double", lambda x: N.round_half_away(x, 2)) == [1.0, 2.5, -2.5]
    assert values(spark, [2.5, -2.5, 0.4], "double", N.round_half_away) == [3.0, -3.0, 0.0]


def test_word_boundaries_are_ascii(spark):
    texts = ["va ccn", "nevada", "éva", "optum/va", "va_x"]
    assert values(spark, texts, "string", lambda t: t.rlike(X.ascii_words(r"\bva\b"))) == [True, False, True, True, False]


def test_pipe_list(spark):
    assert values(spark, [" a | b|| ", ""], "string", X.pipe_list) == [["a", "b"], []]


def test_quote_repair(spark):
    texts = ['"SZ4 9"X 1"', '"ok ""doubled"" ok",2', 'a"b"c', ',"x",']
    assert values(spark, texts, "string", X.repair_quotes) == ['"SZ4 9""X 1"', '"ok ""doubled"" ok",2', 'a""b""c', ',"x",']
    assert values(spark, texts, "string", X.has_stray_quote) == [True, False, True, False]


def test_encoding_repair(spark):
    raw = ["café – €5".encode("cp1252"), "café".encode(), b"\x81x\xe9"]
    assert values(spark, raw, "binary", lambda b: X.repair_encoding(b.cast("string"))) == ["café – €5", "café", "�xé"]


def codes(spark, lists, fn):
    typed = [[{"code": c, "type": t} for c, t in row] for row in lists]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(typed)], f"i int, x {schema.CODES.simpleString()}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


LISTS = [
    [("0611", "RC"), ("70551", "CPT"), ("470", "MS-DRG")],
    [("0470", "MS-DRG"), ("j1000", "HCPCS")],
    [("0470", "MS-DRG")],
    [("000", "MS-DRG")],
    [("0001f", "HCPCS")],
    [("0001F", "HCPCS")],
    [],
]


def test_billing_codes(spark):
    assert codes(spark, LISTS, lambda c: C.billing_code(C.primary_code(c))) == [
        "70551", "J1000", "470", "", "0001F", "0001F", None,
    ]
    assert codes(spark, LISTS, lambda c: C.billing_code_type(C.primary_code(c))) == [
        "CPT", "HCPCS", "MS-DRG", "MS-DRG", "HCPCS", "CPT", None,
    ]


def test_code_signature_ignores_order_and_is_never_null(spark):
    lists = [[("2", "RC"), ("1", "CPT")], [("1", "CPT"), ("2", "RC")], [], [("1", None)]]
    assert codes(spark, lists, C.code_signature) == ["CPT:1,RC:2", "CPT:1,RC:2", "", ""]


def test_clean_codes(spark):
    got = codes(spark, [[(" 1 ", " cpt"), ("", "RC"), (None, "RC")]], C.clean_codes)
    assert [tuple(c) for c in got[0]] == [("1", "CPT")]


def test_schema_differences():
    assert schema.differences(schema.CHARGES, schema.CHARGES) == []
    assert schema.differences(schema.SERVICES, schema.PAYER_PATTERNS)
