"""What steps move and write, on a few rows: the bytes of a large run follow from it."""

from pyspark.sql import functions as F

from tariffscope import session
from tariffscope.operators import audit, prices
from tariffscope.plans import queries, sample_charges, sample_files
from tariffscope.session import materialize
from tariffscope.sources import blocks, csv_files, headers, json_files


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_stay_small_and_tables_are_packed(spark):
    session.configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    files = materialize(spark.range(3), "packed").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_lines_are_shuffled_for_their_order_and_their_part_only(spark, tmp_path):
    tables = {
        "lineitem": """SELECT 1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 2D l_quantity, 10D l_extendedprice, 0.1D l_discount,
            t l_tax, f l_returnflag, s l_linestatus FROM VALUES (0.05D, 'A', 'F'), (0.04D, 'N', 'O'), (null, 'R', null), (0.1D, 'X', 'F'), (0D, null, 'O') v(t, f, s)""",
        "orders": "SELECT 1L o_orderkey, 4L o_custkey, p o_orderpriority FROM VALUES ('2-HIGH'), ('odd'), (null) v(p)",
        "customer": "SELECT 4L c_custkey, 6 c_nationkey, s c_mktsegment FROM VALUES ('HOUSEHOLD'), ('odd'), (null) v(s)",
        "part": "SELECT 2L p_partkey, 'thing' p_name, 7D p_retailprice",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        charges = sample_charges.charges(spark, str(tmp_path))
        shuffles = [line for line in _plan(charges).splitlines() if "Exchange hashpartitioning" in line]
        found = charges.select("setting", "modifiers", "plan_name", "payer_name", (F.col("median_amount").isNotNull()).alias("paid")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # orders meet their customers below the join with the lines, so lines are not shuffled by customer
    depth = {key: s.index("Exchange") for s in shuffles for key in ("l_orderkey", "o_custkey") if f"({key}#" in s}
    assert depth["l_orderkey"] < depth["o_custkey"]
    told = {(r.setting, r.modifiers, r.paid) for r in found}
    assert told == {("Inpatient", None, True), (" outpatient", "50", False), ("both", None, False), ("both", None, True), ("both", "50", False)}
    assert {r.plan_name for r in found} == {"MEDICARE - NO IME", None} and {r.payer_name for r in found} == {"Fallon [1206]", None}
    assert len(found) == 5 * 3 * 3


def test_list_prices_take_one_shuffle_and_a_short_key(spark):
    rows = [("h", "a", "s", None, "both", "c", "CPT", 5.0, None, 2), ("h", "a", "s", None, "in", "c", "CPT", None, 4.0, 1), ("h", "b", "s", "m", "in", None, None, None, None, 1)]
    names = [*prices.ITEM_SETTING, "billing_code", "billing_code_type", *prices.PRICES, "n_rows"]
    types = ["double" if n in prices.PRICES else "long" if n == "n_rows" else "string" for n in names]
    points = materialize(spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))), "points")
    found = prices.resolved_prices(points)
    assert _plan(found).count("Exchange hashpartitioning") == 1
    told = found.join(points.select(prices.item_key().alias("item_key"), "description", "setting"), "item_key").select("description", "setting", found.gross_charge, found.discounted_cash, "list_price_match", F.octet_length("item_key").alias("k")).collect()
    assert {tuple(r) for r in told} == {("a", "both", 5.0, 4.0, "same item", 16), ("a", "in", 5.0, 4.0, "same item, other setting", 16), ("b", "in", None, None, None, 16)}


def test_texts_of_split_documents_are_written_twice(spark, monkeypatch):
    written = []

    def noted(df, name):
        written.append((name, "value" in df.columns))
        return materialize(df, name)

    monkeypatch.setattr(json_files, "materialize", noted)
    monkeypatch.setattr(blocks, "materialize", noted)
    text = '{"hospital_name": "a } [ \\" b", "standard_charge_information": [{"description": "x}"}, {"description": "y", "drug_information": {"unit": "1"}}]}'
    pieces = [("f", i // 2, i, p) for i, p in enumerate(text.split("}")[:-1])] + [("cut", 0, i, p) for i, p in enumerate(text[:-2].split("}"))]
    items, documents = json_files.split_documents(spark.createDataFrame(pieces, "path string, block long, place long, value string"))
    assert sorted((r.path, r.item.description) for r in items.collect()) == [("f", "x}"), ("f", "y")]
    assert [r.path for r in documents.collect()] == ["f"]
    assert [name for name, has_text in written if has_text] == ["pieces", "json_parts"]


def test_a_plan_says_something_unless_all_its_cells_are_blank(spark):
    names = [*headers.WIDE_COLUMNS.values()]
    at = {n: i for i, n in enumerate(names)}
    group = F.struct(F.lit("P").alias("payer_name"), F.lit("Q").alias("plan_name"), *[F.lit(i).alias(n) for n, i in at.items()])
    base = F.struct(*[F.lit(None).cast("int").alias(n) for n in headers.BASE_COLUMNS.values()])
    codes = F.array().cast("array<struct<code int, type int>>")
    layouts = spark.range(1).select(
        F.lit("f").alias("path"), F.lit("h").alias("hospital_id"), F.lit("csv_wide").alias("source_format"), F.lit(None).cast("string").alias("error"),
        F.array(F.lit("head")).alias("head_lines"), F.lit(len(names)).alias("n_cells"), codes.alias("codes"), base.alias("base"), F.array(group).alias("groups"))
    lines = [",".join([""] * len(names)), ",".join(["  "] * len(names)), ",".join(["x"] + [" "] * (len(names) - 1)), "7"]
    records = spark.createDataFrame([("f", line) for line in lines], "path string, value string")
    found = csv_files.wide_to_charges(records, layouts)
    assert sorted(r.payer_name or "" for r in found.collect()) == ["", "", "", "", "P", "P"]


def test_wide_records_spell_the_rates_once(spark):
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        heads, records = sample_files.wide_file(spark, "/root/testdata/sf0.001")
        line = records._jdf.queryExecution().analyzed().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    width = len(heads.first().header)
    assert [r.n for r in records.select(F.size(csv_files.cells(F.col("value"))).alias("n")).distinct().collect()] == [width]
    # once where it is spelt and once where it is handed on, and not for every plan
    assert max(text.count("p90_amount#") for text in line) < len(sample_files.WIDE_PLANS)


def _conditions(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")


def test_only_the_cells_that_are_asked_for_are_read(spark):
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        heads, records = sample_files.wide_file(spark, "/root/testdata/sf0.001")
        wide = csv_files.wide_to_charges(records, headers.layouts(heads))
        documents = spark.createDataFrame([], f"id int, {json_files.ITEMS}")
        nested = json_files.documents_to_charges(documents, "id")
        # one number is asked for, not the ten of a charge
        told = [_conditions(df.where("payer_name is not null").select("payer_name", "negotiated_dollar")) for df in (wide, nested)]
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert told == [1, 1]


def test_json_items_keep_one_row_without_a_payer(spark):
    text = """{"standard_charge_information": [{"description": "x", "standard_charges": [{"gross_charge": "$1,200", "additional_generic_notes": "n",
        "payers_information": [{"payer_name": " P ", "standard_charge_dollar": 5, "additional_payer_notes": ""}, {"payer_name": "Q", "additional_payer_notes": "own"}]}, {"setting": "both"}]}]}"""
    documents = spark.createDataFrame([(1, text)], "id int, value string").select("id", F.from_json("value", f"struct<{json_files.ITEMS}>").alias("d")).select("id", "d.*")
    rows = json_files.documents_to_charges(documents, "id").select("payer_name", "gross_charge", "negotiated_dollar", "notes", "setting").collect()
    assert [tuple(r) for r in rows] == [(None, 1200.0, None, "n", None), ("P", 1200.0, 5.0, "n", None), ("Q", 1200.0, None, "own", None), (None, None, None, None, "both")]


def test_three_layouts_come_from_one_table_of_charges(spark, monkeypatch):
    taken = []
    made = sample_charges.charges
    monkeypatch.setattr(sample_charges, "charges", lambda *args: taken.append(args) or made(*args))
    queries.queries()["layout_parity"](spark, "/root/testdata/sf0.001")
    assert len(taken) == 1


def test_small_values_travel_in_one_number(spark):
    rows = [(n, a, b) for n in (None, 0, 7, -3, 2**31 - 1, -(2**31)) for a in (None, 0, 8) for b in (None, 0, 1)]
    df = spark.createDataFrame(rows, "n int, a int, b int")
    packed = df.select("*", sample_charges._packed(F.col("n"), [(F.col("a").cast("bigint"), 9), (F.col("b").cast("bigint"), 2)]).alias("p"))
    found = packed.select("n", "a", "b", F.array(*sample_charges._unpacked(F.col("p"), [9, 2])).alias("told")).collect()
    assert all([r.n, r.a, r.b] == r.told for r in found) and len(found) == len(rows)


def test_lines_carry_one_number_besides_their_keys_and_amounts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sample_charges.charges(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(l_partkey" in line)
    sent = next(line for line in lines[at:] if "Project [" in line)
    assert sent.split("Project [")[1].count(",") + 1 <= 6


def test_digests_are_counted_in_half_their_bytes(spark):
    keys = ["", "ab", "AB", "abc", "h1", "00", "0f" * 16, "é", "\x01"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", F.expr(audit._short("k")).alias("short"))
    found = df.select("k", F.expr(audit._long("short")).alias("told"), F.octet_length("short").alias("n")).collect()
    assert [r.told for r in found] == keys and {r.k: r.n for r in found}["0f" * 16] == 17


def test_tables_of_a_task_do_not_grow_with_the_input(spark):
    """With two shuffle partitions asked for, the first partitions are many and joined by their bytes."""
    session.configure(spark)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        rows = spark.range(300_000).select(F.concat(F.lit("h"), (F.col("id") % 5).cast("string")).alias("hospital_id"), F.md5(F.col("id").cast("string")).alias("description"))
        tasks = rows.repartition("description").groupBy("description").agg(F.count("*")).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert tasks > 5
