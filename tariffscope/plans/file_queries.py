"""Registered queries of the ingest side: layouts, text repair, metadata, index, admission, storage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tariffscope import schema
from tariffscope.functions import text as X
from tariffscope.functions.dates import flexible_date
from tariffscope.operators import quality
from tariffscope.plans import admit, oracle, pipeline, sample_charges, sample_files
from tariffscope.plans.queries import register
from tariffscope.session import materialize, shared_dir
from tariffscope.sources import admission, blocks, csv_files, drift, headers, index, json_files, store, tables

# Codes compare as one text; both sides build it the same way.
_CODES = "array_to_string(list_transform(codes, lambda c: c.code || '/' || upper(c.type)), ' ') AS codes"
_LONG = f"""hospital_id, {_CODES}, gross_charge, discounted_cash, min_charge, max_charge, negotiated_dollar,
negotiated_percentage, negotiated_algorithm, methodology, median_amount, p10_amount, p90_amount, allowed_count,
modifiers, payer_name, plan_name, drug_unit, drug_unit_type, estimated_amount"""
_LONG_COLUMNS = [c.strip().split(" ")[-1] for c in _LONG.replace(_CODES, "codes").split(",")]
_RATE = [
    "payer_name", "plan_name", "negotiated_dollar", "negotiated_percentage", "negotiated_algorithm",
    "median_amount", "p10_amount", "p90_amount", "allowed_count", "methodology", "estimated_amount",
]


def _plain_codes(charges):
    joined = F.array_join(F.transform("codes", lambda c: F.concat(c["code"], F.lit("/"), c["type"])), " ")
    return charges.withColumn("codes", joined)


def _parsed(files, parse):
    """Parse stored records with stored layouts, as the ingest job does."""
    heads, records = files
    return parse(materialize(records, "records"), materialize(headers.layouts(heads), "layouts"))


def _tall(spark, sf, charges=None):
    return _parsed(sample_files.tall_file(spark, sf, charges), csv_files.tall_to_charges)


def _wide(spark, sf, charges=None):
    return _parsed(sample_files.wide_file(spark, sf, charges), csv_files.wide_to_charges)


def _json(spark, sf, charges=None):
    texts = materialize(sample_files.json_texts(spark, sf, charges), "documents")
    docs = texts.select("hospital_id", F.from_json("value", f"struct<{json_files.ITEMS}>").alias("d"))
    return json_files.documents_to_charges(docs.select("hospital_id", "d.*"), "hospital_id")


_TALL_SQL = oracle.sql(
    f"""SELECT trim(description) AS description, trim(setting) AS setting, trim(notes) AS notes, {_LONG}
    FROM (SELECT * REPLACE (trim(payer_name) AS payer_name, trim(plan_name) AS plan_name) FROM charges)""",
    "charges",
)


@register("tall_to_long", _TALL_SQL)
def _(spark, sf):
    return _plain_codes(_tall(spark, sf)).select("description", "setting", "notes", *_LONG_COLUMNS)


@register("ingested_files", _TALL_SQL)
def _(spark, sf):
    """The tall files of all hospitals, written to the shared folder and read by the ingest job."""
    files, out = _landing(spark, sf), f"{shared_dir(spark)}/ingested-{uuid.uuid4().hex}"
    pipeline.ingest_files(spark, files, out)
    return _plain_codes(store.read_charges(spark, out)).select("description", "setting", "notes", *_LONG_COLUMNS)


_LAYOUTS = """SELECT 'h' || n_nationkey AS hospital_id, CASE WHEN n_nationkey < 2 THEN 'csv_wide' WHEN n_nationkey < 5 THEN 'json' END AS source_format,
    CASE n_nationkey WHEN 5 THEN '{no_header}' WHEN 6 THEN '{no_layout}' END AS error, CASE WHEN n_nationkey < 5 THEN n_name || ' Hospital' END AS hospital_name,
    CASE WHEN n_nationkey < 2 THEN 'CA' WHEN n_nationkey < 5 THEN 'NY' END AS license_state, CASE WHEN n_nationkey < 5 THEN n_nationkey % 2 = 0 END AS attestation_confirmed,
    CASE WHEN n_nationkey < 2 THEN '100000' || n_nationkey || ';200000' || n_nationkey WHEN n_nationkey < 5 THEN '100000' || n_nationkey END AS npi,
    row_count, row_count AS counted, payer_rows, drug_rows, estimated_rows, highest, payer_notes
    FROM nation LEFT JOIN (SELECT hospital_id, count(*) + count(payer_name) AS row_count, count(payer_name) AS payer_rows,
        count(drug_unit) + count(CASE WHEN payer_name IS NOT NULL THEN drug_unit END) AS drug_rows, count(estimated_amount) AS estimated_rows,
        max(estimated_amount) AS highest, count(CASE WHEN allowed_count = '7' AND hospital_id NOT IN ('h0', 'h1') THEN 1 END) AS payer_notes
        FROM charges GROUP BY hospital_id) ON hospital_id = 'h' || n_nationkey WHERE n_nationkey < 7"""


@register("ingested_layouts", oracle.sql(_LAYOUTS.format(no_header=headers.NO_HEADER, no_layout=headers.NO_LAYOUT), "charges"))
def _(spark, sf):
    """Wide and JSON files with their metadata, and two that are no price files, through the ingest job and its store."""
    out = f"{shared_dir(spark)}/ingested-{uuid.uuid4().hex}"
    of = lambda df, *ids: df.where(F.element_at(F.split("path", "/"), 1).isin(*ids))
    wide = of(sample_files.csv_texts(sample_files.wide_file(spark, sf)), "h0", "h1")
    nested = of(sample_files.json_files(spark, sf, sample_files.json_texts(spark, sf)), "h2", "h3", "h4")
    junk = spark.createDataFrame([("h5/a", 0, "a,b"), ("h6/a", 0, "description,foo")], "path string, order int, value string")
    landing = _landing_folder(spark)
    _write_files(wide.unionByName(junk), landing)
    _write_files(nested, landing, "}")
    pipeline.ingest_files(spark, _listed(spark, landing), out)
    charges = store.read_charges(spark, out)
    told = charges.groupBy("hospital_id").agg(
        F.count("*").alias("counted"), F.count("payer_name").alias("payer_rows"), F.count("drug_unit").alias("drug_rows"),
        F.count("estimated_amount").alias("estimated_rows"), F.max("estimated_amount").alias("highest"),
        F.count_if(F.col("notes") == sample_files.PAYER_NOTES).alias("payer_notes"),
    )
    state = store.read_state(spark, out).select("hospital_id", "source_format", "error", "row_count", "record")
    return state.join(told, "hospital_id", "left").select(
        "hospital_id", "source_format", "error", "record.hospital_name", "record.license_state", "record.attestation_confirmed",
        F.array_join("record.type_2_npi", ";").alias("npi"), "row_count", *[c for c in told.columns if c != "hospital_id"],
    )


def _landing_folder(spark):
    return f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"


def _write_files(lines, landing, end="\n"):
    """Lines (path, order, value) as compressed text files in parts, one file for each path. Nothing is shuffled: every task
    writes the parts of its own lines, those of a lower order into a folder that comes before. JSON ends each line with a brace.
    """
    names = F.split("path", "/")
    value = F.regexp_replace("value", r"\}\z", "") if end == "}" else F.col("value")
    file = F.concat(F.coalesce(F.element_at(names, -1), F.lit("none")), F.lit(blocks.PARTS))
    placed = lines.select(F.element_at(names, 1).alias("of"), file.alias("file"), F.col("order").alias("step"), value.alias("value"))
    writer = placed.sortWithinPartitions("of", "file", "step").write.mode("append").partitionBy("of", "file", "step")
    writer.option("lineSep", end).option("compression", "gzip").text(landing)


def _listed(spark, landing):
    return headers.list_files(spark, landing).withColumn("hospital_id", F.regexp_replace("hospital_id", "^of=", ""))


def _landing(spark, sf):
    """The tall files as text files, one for each hospital; and one file that is none."""
    landing = _landing_folder(spark)
    heads, records = sample_files.tall_file(spark, sf)
    _write_files(records.select("path", F.lit(1).alias("order"), "value"), landing)
    head = F.transform("head_lines", lambda line: F.struct(F.lit(0).alias("order"), line.alias("value")))
    first = heads.join(_listed(spark, landing), "hospital_id", "left_semi").select(heads.path, F.inline(head))
    junk = heads.where("hospital_id = 'h5'").select("path", F.lit(0).alias("order"), F.lit("a,b").alias("value"))
    _write_files(first.unionByName(junk).coalesce(1), landing)
    return _listed(spark, landing)


@register(
    "admission_runs",
    oracle.sql(
        f"""SELECT hospital_id, CASE WHEN lost AND NOT pinned THEN 'missing' WHEN k = 5 THEN 'rejected' WHEN k > 5 THEN 'missing'
        WHEN pinned THEN 'pinned' ELSE 'found' END AS state, CASE WHEN k <= 5 THEN 'new' END AS first_status,
        CASE WHEN k <= 4 THEN CASE WHEN k = 1 THEN 'unchanged_content' ELSE 'unchanged_remote' END WHEN k = 5 THEN 'new' END AS second_status,
        CASE WHEN lost AND NOT pinned THEN 'no location matching ''Nowhere''; listed: ' || locations WHEN k = 5 THEN '{headers.NO_HEADER}'
        WHEN k > 5 THEN 'no file was fetched from ' || url END AS error, CASE WHEN k <= 4 THEN row_count END AS row_count,
        CASE WHEN k <= 4 THEN 'csv_tall' END AS source_format, coalesce(row_count, 0) AS charges
        FROM (SELECT n_nationkey AS k, 'h' || n_nationkey AS hospital_id, r_name AS site, n_name, n_nationkey % 5 = 4 AS pinned,
        n_nationkey % 7 = 6 AS lost, 'https://' || r_name || '/h' || n_nationkey || '.csv' AS url FROM nation JOIN region ON n_regionkey = r_regionkey)
        JOIN (SELECT r_name AS site, string_agg(n_name || ' Hospital', ', ' ORDER BY n_name || ' Hospital') AS locations
        FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name) USING (site)
        LEFT JOIN (SELECT hospital_id, count(*) AS row_count FROM charges GROUP BY hospital_id) USING (hospital_id)""",
        "charges",
    ),
)
def _(spark, sf):
    """From index texts to stored charges and failures, twice. In between one file gets a new mark but no new content."""
    out, key = f"{shared_dir(spark)}/admitted-{uuid.uuid4().hex}", F.col("n_nationkey")
    nations = sample_charges.table(spark, sf, "nation").join(
        sample_charges.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    hospital = F.concat(F.lit("h"), key.cast("string"))
    url = F.concat(F.lit("https://"), "r_name", F.lit("/"), hospital, F.lit(".csv"))
    record = F.concat(F.lit("location-name: "), "n_name", F.lit(" Hospital\nmrf-url: "), url)
    sites = nations.groupBy(F.col("r_name").alias("site")).agg(F.array_join(F.array_sort(F.collect_list(record)), "\n\n").alias("text"))
    targets = nations.select(
        hospital.alias("hospital_id"),
        F.col("r_name").alias("site"),
        F.when(key % 7 == 6, "Nowhere").otherwise(F.lower("n_name")).alias("location_match"),
        F.when(key % 5 == 4, url).alias("pinned_url"),
    )
    files = _landing(spark, sf).select("hospital_id", "path")
    marks = nations.select(hospital.alias("hospital_id"), url.alias("url"), F.concat(F.lit("v1-"), hospital).alias("etag"))
    landed = marks.join(files, "hospital_id").withColumn("last_modified", F.lit(None).cast("string"))
    first = materialize(admit.ingest_index(spark, targets, sites, landed, out, run="first"), "entries")
    renewed = landed.withColumn("etag", F.when(F.col("hospital_id") == "h1", "v2").otherwise(F.col("etag")))
    second = admit.ingest_index(spark, targets, sites, renewed, out, run="second")
    rows = tables.row_counts(store.read_charges(spark, out)).withColumnRenamed("row_count", "charges")
    told = second.select(
        "hospital_id", "state", F.col("status").alias("second_status"), "error", "row_count", F.col("record.source_format").alias("source_format")
    )
    return told.join(first.select("hospital_id", F.col("status").alias("first_status")), "hospital_id").join(
        rows, "hospital_id", "left"
    ).withColumn("charges", F.coalesce("charges", F.lit(0)))


_NO_PAYER = ", ".join(f"NULL AS {c}" for c in _RATE)


@register(
    "wide_to_long",
    oracle.sql(
        f"""SELECT trim(description) AS description, trim(setting) AS setting, notes, {_LONG} FROM (
        SELECT * REPLACE ({_NO_PAYER}) FROM charges UNION ALL
        SELECT * REPLACE ('{sample_files.WIDE_PAYER}' AS payer_name, coalesce(trim(plan_name), 'None') AS plan_name)
        FROM charges WHERE payer_name IS NOT NULL)""",
        "charges",
    ),
)
def _(spark, sf):
    return _plain_codes(_wide(spark, sf)).select("description", "setting", "notes", *_LONG_COLUMNS)


@register(
    "json_to_long",
    oracle.sql(
        f"""SELECT description, setting, notes, {_LONG} FROM (
        SELECT * REPLACE ({_NO_PAYER}) FROM charges UNION ALL
        SELECT * REPLACE (trim(payer_name) AS payer_name, trim(plan_name) AS plan_name,
            CASE WHEN allowed_count = '7' THEN '{sample_files.PAYER_NOTES}' ELSE notes END AS notes)
        FROM charges WHERE payer_name IS NOT NULL)""",
        "charges",
    ),
)
def _(spark, sf):
    return _plain_codes(_json(spark, sf)).select("description", "setting", "notes", *_LONG_COLUMNS)


@register(
    "json_split_items",
    oracle.sql(
        f"""SELECT description, setting, notes, {_LONG} FROM (
        SELECT * REPLACE ({_NO_PAYER}) FROM charges UNION ALL
        SELECT * REPLACE (trim(payer_name) AS payer_name, trim(plan_name) AS plan_name,
            CASE WHEN allowed_count = '7' THEN '{sample_files.PAYER_NOTES}' ELSE notes END AS notes)
        FROM charges WHERE payer_name IS NOT NULL)""",
        "charges",
    ),
)
def _(spark, sf):
    """One big document per hospital, cut at braces in blocks, as a large file is read."""
    texts = sample_files.json_texts(spark, sf).sortWithinPartitions("hospital_id")
    chunks = sample_files.json_chunks(materialize(texts, "documents"))
    items, _ = json_files.split_documents(chunks)
    charges = json_files.items_to_charges(items, "path").withColumnRenamed("path", "hospital_id")
    return _plain_codes(charges).select("description", "setting", "notes", *_LONG_COLUMNS)


_PARITY = [c for c in _RATE if c != "payer_name"]
_PARITY_SQL = ", ".join(_PARITY).replace("plan_name", "coalesce(trim(plan_name), 'None') AS plan_name")


@register(
    "layout_parity",
    oracle.sql(
        f"""SELECT hospital_id, count(*) AS differing, CAST(sum(t - least(t, w, j)) AS BIGINT) AS more_in_tall, CAST(sum(w - least(t, w, j)) AS BIGINT) AS more_in_wide,
        CAST(sum(j - least(t, w, j)) AS BIGINT) AS more_in_json FROM (SELECT * EXCLUDE (t, w, j), sum(t) AS t, sum(w) AS w, sum(j) AS j FROM (
        SELECT hospital_id, trim(description) AS description, {_PARITY_SQL.replace("allowed_count", "x.c AS allowed_count")}, x.t, x.w, x.j FROM (
            SELECT *, unnest([{{'t': CASE WHEN description LIKE '%1' THEN 0 ELSE 1 END, 'w': CASE WHEN description LIKE '%2' THEN 2 ELSE 1 END,
            'j': CASE WHEN description LIKE '%3' THEN 0 ELSE 1 END, 'c': allowed_count}}, {{'t': 0, 'w': 0, 'j': CASE WHEN description LIKE '%3' THEN 1 ELSE 0 END, 'c': 'many'}}]) AS x
            FROM charges WHERE payer_name IS NOT NULL)
        ) GROUP BY ALL) WHERE t <> w OR t <> j GROUP BY hospital_id""",
        "charges",
    ),
)
def _(spark, sf):
    """How the payer rates of three layouts differ, after rows were taken out of one, doubled in another and changed in the third."""

    def rates(charges):
        plan = F.coalesce(F.trim("plan_name"), F.lit("None"))
        rows = charges.where("payer_name is not null").withColumn("description", F.trim("description")).withColumn("plan_name", plan)
        return rows.select("hospital_id", "description", *_PARITY)

    ends = lambda digit: F.coalesce(F.col("description").like(f"%{digit}"), F.lit(False))
    charges = materialize(sample_charges.charges(spark, sf), "charges")
    wide, nested = rates(_wide(spark, sf, charges)), rates(_json(spark, sf, charges))
    layouts = {
        "tall": rates(_tall(spark, sf, charges)).where(~ends(1)),
        "wide": wide.withColumn("_copy", F.explode(F.when(ends(2), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_copy"),
        "json": nested.withColumn("allowed_count", F.when(ends(3), "many").otherwise(F.col("allowed_count"))),
    }
    least = F.least("tall", "wide", "json")
    return quality.layout_differences(layouts).groupBy("hospital_id").agg(
        F.count("*").alias("differing"), *[F.sum(F.col(name) - least).alias(f"more_in_{name}") for name in layouts]
    )


@register(
    "schema_drift",
    oracle.sql(
        """SELECT hospital_id, name, found, wanted FROM (SELECT hospital_id, unnest(CASE hospital_id
        WHEN 'h1' THEN [{'name': 'gross_charge', 'found': 'string', 'wanted': 'double'}] WHEN 'h2' THEN [{'name': 'notes', 'found': NULL, 'wanted': 'string'}]
        WHEN 'h3' THEN [{'name': 'extra', 'found': 'int', 'wanted': NULL}] WHEN 'h4' THEN [{'name': 'codes', 'found': 'array<struct<code:string>>', 'wanted': 'array<struct<code:string,type:string>>'}]
        END, recursive := true) FROM (SELECT DISTINCT hospital_id FROM charges))""",
        "charges",
    ),
)
def _(spark, sf):
    """Stored partitions of which four were written by other code: a type, a column less, one more, a field less."""
    folder = f"{shared_dir(spark)}/drifted-{uuid.uuid4().hex}"
    stored = materialize(sample_charges.charges(spark, sf), "charges")
    tables.write_charges(stored, folder)
    codes = F.transform("codes", lambda c: F.struct(c["code"].alias("code")))
    others = {
        "h1": stored.withColumn("gross_charge", F.col("gross_charge").cast("string")),
        "h2": stored.drop("notes"),
        "h3": stored.withColumn("extra", F.lit(1)),
        "h4": stored.withColumn("codes", codes),
    }
    for hospital, changed in others.items():
        rows = changed.where(F.col("hospital_id") == hospital).drop("hospital_id")
        rows.write.mode("overwrite").parquet(f"{folder}/{tables.partition_folder(hospital)}")
    found = drift.drift(drift.footers(spark, folder), schema.CHARGES_STORED, ["hospital_id"])
    return found.select("hospital_id", "name", "found", "wanted").distinct()


@register(
    "stored_row_counts", oracle.sql("SELECT hospital_id, count(*) AS row_count FROM charges GROUP BY ALL", "charges")
)
def _(spark, sf):
    """Partitioned write, read with the fixed schema, rows per hospital."""
    folder = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    tables.write_charges(sample_charges.charges(spark, sf), folder)
    return tables.row_counts(tables.read_charges(spark, folder))


# ---- scalar rules ------------------------------------------------------------------------------

_MONEY_CASES = """CASE p_partkey % 7 WHEN 0 THEN ' $' || digits WHEN 1 THEN '1,' || digits WHEN 2 THEN '' WHEN 3 THEN 'n/a'
WHEN 4 THEN digits || 'd' WHEN 5 THEN '1_' || digits ELSE '-' || digits || 'e1 ' END"""


@register(
    "money_cleanse",
    f"""SELECT p_partkey, price_text, CASE WHEN regexp_full_match(bare, '[+-]?[0-9]+[.]?[0-9]*([eE][+-]?[0-9]+)?')
    THEN CAST(bare AS DOUBLE) END AS price FROM (SELECT *, regexp_replace(trim(price_text), '[$,]', '', 'g') AS bare FROM (
    SELECT p_partkey, {_MONEY_CASES} AS price_text FROM (SELECT p_partkey,
    CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS VARCHAR) AS digits FROM part)))""",
)
def _(spark, sf):
    part = sample_charges.table(spark, sf, "part")
    digits = part.select("p_partkey", F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("digits"))
    texts = digits.select("p_partkey", F.expr(_MONEY_CASES).alias("price_text"))
    return texts.withColumn("price", X.money(F.col("price_text")))


@register(
    "flexible_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
)
def _(spark, sf):
    orders, key, day = sample_charges.table(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_orderdate")
    written = (
        F.when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 3 == 1, F.date_format(day, "M/d/yyyy"))
        .otherwise(F.date_format(day, "MMM yyyy"))
    )
    return orders.select("o_orderkey", flexible_date(written).alias("parsed"))


# ---- text repair -------------------------------------------------------------------------------

_RE2_STRAY = r"""([^,"\r\n])"([^,"\r\n])"""


@register(
    "repair_quotes",
    rf"""SELECT page_id, count(*) AS lines, CAST(sum(CAST(regexp_matches(line, '{_RE2_STRAY}') AS INTEGER)) AS BIGINT) AS repaired_quote_lines,
    md5(string_agg(regexp_replace(regexp_replace(line, '{_RE2_STRAY}', '\1""\2', 'g'), '{_RE2_STRAY}', '\1""\2', 'g'),
    chr(10) ORDER BY pos)) AS text_hash
    FROM (SELECT page_id, unnest(string_split(html, chr(10))) AS line,
          generate_subscripts(string_split(html, chr(10)), 1) AS pos FROM pages) GROUP BY page_id""",
)
def _(spark, sf):
    lines = F.split("html", "\n")
    pages = sample_charges.table(spark, sf, "pages").select("page_id", lines.alias("lines"))
    return pages.select(
        "page_id",
        F.size("lines").cast("long").alias("lines"),
        F.size(F.filter("lines", X.has_stray_quote)).cast("long").alias("repaired_quote_lines"),
        F.md5(F.array_join(F.transform("lines", X.repair_quotes), "\n")).alias("text_hash"),
    )


@register(
    "repair_encoding",
    r"""SELECT doc_id, text AS repaired, regexp_matches(text, '[^\x{00}-\x{7F}]') AND
    NOT regexp_matches(text, '[^\x{00}-\x{FF}]') AS non_utf8 FROM documents""",
)
def _(spark, sf):
    """Western texts saved in a one-byte code page, all others in UTF-8, back to text."""
    western = ~F.col("text").rlike(r"[^\x{00}-\x{FF}]")
    stored = F.when(western, F.encode("text", "ISO-8859-1").cast("string")).otherwise(F.col("text"))
    docs = sample_charges.table(spark, sf, "documents").select("doc_id", stored.alias("value"))
    return docs.select(
        "doc_id",
        X.repair_encoding(F.col("value")).alias("repaired"),
        X.is_bad_utf8(F.col("value")).alias("non_utf8"),
    )


@register(
    "repair_counters",
    rf"""SELECT lang AS path, CAST(count_if(regexp_matches(line, '{_RE2_STRAY}')) AS BIGINT) AS repaired_quote_lines,
    CAST(0 AS BIGINT) AS non_utf8_lines,
    CAST(count_if((length(line) - length(replace(line, '"', ''))) % 2 = 1) AS BIGINT) AS odd_quote_lines
    FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY lang""",
)
def _(spark, sf):
    """Repair counters per file, a language taken as one file."""
    docs = sample_charges.table(spark, sf, "documents")
    lines = docs.select(F.col("lang").alias("path"), F.explode(F.split("text", "\n")).alias("value"))
    return csv_files.line_stats(csv_files.repair(lines))


@register(
    "broken_records",
    """SELECT lang AS path, doc_id, 'd' || doc_id || ',"' || replace(text, '"', '""') || '",end' AS value FROM documents""",
)
def _(spark, sf):
    """Whole texts as quoted fields over many lines, a language taken as one file in blocks of documents."""
    docs = sample_charges.table(spark, sf, "documents").select("doc_id", "lang", "text")
    field = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    record = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(","), field, F.lit(",end"))
    lines = docs.select(
        F.col("lang").alias("path"),
        F.floor(F.col("doc_id") / 16).alias("block"),
        "doc_id",
        F.posexplode(F.split(record, "\n")).alias("pos", "value"),
    ).withColumn("place", F.struct("doc_id", "pos"))
    # Every other block border falls inside a document, so records are cut there.
    moved = lines.withColumn("block", F.when(F.col("doc_id") % 16 == 15, F.col("block") + (F.col("pos") > 0).cast("int"))
                             .otherwise(F.col("block")))
    records = csv_files.join_broken_records(moved)
    doc_id = F.substring(F.get(F.split("value", ",", 2), F.lit(0)), F.lit(2), F.lit(20)).cast("long")
    return records.withColumn("doc_id", doc_id)


# ---- metadata, index, admission ----------------------------------------------------------------


@register(
    "header_layout",
    """SELECT 'h' || n_nationkey || '/' || f AS path, 'csv_' || replace(f, '.csv', '') AS source_format, n_cells, n_codes,
    n_groups, description_at, first_dollar_at FROM nation, (VALUES ('tall.csv', 25, 2, 0, 4, 16), ('wide.csv', 64, 2, 5, 4, 14))
    v(f, n_cells, n_codes, n_groups, description_at, first_dollar_at)""",
)
def _(spark, sf):
    """Column positions found in the padded, upper-case and wide header rows."""
    heads = sample_files.tall_file(spark, sf)[0].unionByName(sample_files.wide_file(spark, sf)[0])
    return headers.layouts(heads).select(
        "path",
        "source_format",
        "n_cells",
        F.size("codes").alias("n_codes"),
        F.size("groups").alias("n_groups"),
        F.col("base.description").alias("description_at"),
        F.coalesce("payer.negotiated_dollar", F.get("groups", F.lit(0))["negotiated_dollar"]).alias("first_dollar_at"),
    )


@register(
    "header_metadata",
    """SELECT 'h' || n_nationkey AS hospital_id, n_name || ' Hospital' AS hospital_name,
    '7/' || (1 + n_nationkey) || '/2026' AS last_updated_on, '3.0.0' AS version,
    n_name || ' North;' || n_name || ' South' AS location_name,
    n_nationkey || ' Main Street, Springfield' AS hospital_address,
    '100000' || n_nationkey || ';200000' || n_nationkey AS type_2_npi,
    CAST(n_nationkey AS VARCHAR) AS license_number, 'CA' AS license_state,
    n_nationkey % 2 = 0 AS attestation_confirmed, 'Attester ' || n_nationkey AS attester_name FROM nation""",
)
def _(spark, sf):
    heads, _ = sample_files.tall_file(spark, sf)
    meta = headers.as_hospitals(headers.csv_metadata(heads))
    lists = {f.name: F.array_join(f.name, ";") for f in schema.HOSPITALS if f.dataType == schema.HOSPITALS["type_2_npi"].dataType}
    return meta.withColumns(lists).drop(
        "source_file", "source_format", "row_count", "parsed_at", "repaired_quote_lines", "non_utf8_lines"
    )


_INDEX = """SELECT 'site-' || page_id AS site, r.position, r.location, r.url, r.page FROM (SELECT page_id, unnest([
{'position': 0, 'location': 'Hospital ' || page_id, 'url': url || '/a.csv', 'page': url},
{'position': 4, 'location': 'Clinic ' || page_id, 'url': url || '/b.json', 'page': NULL},
{'position': 7, 'location': 'Annex ' || page_id, 'url': url || '/c.csv', 'page': NULL}]) AS r FROM pages)"""


@register("index_blocks", _INDEX)
def _(spark, sf):
    entry = F.col("entry")
    return index.parse_indexes(sample_files.index_texts(spark, sf)).select(
        "site",
        "position",
        entry["location-name"].alias("location"),
        entry["mrf-url"].alias("url"),
        entry["source-page-url"].alias("page"),
    )


@register(
    "index_lookup",
    """SELECT 'p' || page_id AS hospital_id, CASE page_id % 4 WHEN 0 THEN 'https://pinned.example/' || page_id
    WHEN 1 THEN url || '/b.json' WHEN 2 THEN url || '/a.csv' END AS url,
    CASE WHEN page_id % 4 = 3 THEN 'no location matching ''Nowhere''; listed: Annex ' || page_id || ', Clinic ' || page_id
    || ', Hospital ' || page_id END AS error FROM pages""",
)
def _(spark, sf):
    texts, key = sample_files.index_texts(spark, sf), F.col("page_id")
    wanted = F.when(key % 4 == 1, "cLINIC").when(key % 4 == 2, "").when(key % 4 == 3, "Nowhere").otherwise("Hospital")
    targets = texts.select(
        F.concat(F.lit("p"), key.cast("string")).alias("hospital_id"),
        "site",
        wanted.alias("location_match"),
        F.when(key % 4 == 0, F.concat(F.lit("https://pinned.example/"), key.cast("string"))).alias("pinned_url"),
    )
    return index.find_files(targets, index.parse_indexes(texts))


@register(
    "admit_new_files",
    """SELECT 'd' || doc_id AS hospital_id, sha256(text) AS sha256, CASE WHEN doc_id % 5 IN (0, 1) THEN 'unchanged_remote'
    WHEN doc_id % 5 = 2 THEN 'unchanged_content' ELSE 'new' END AS status FROM documents""",
)
def _(spark, sf):
    """Documents as downloaded files, against a manifest of which a part is outdated or missing."""
    key, content = F.col("doc_id"), F.sha2(F.col("text").cast("binary"), 256)
    text = key.cast("string")
    docs = sample_charges.table(spark, sf, "documents")
    files = docs.select(
        F.concat(F.lit("d"), text).alias("hospital_id"),
        F.concat(F.lit("landing/"), text).alias("path"),
        F.when(key % 5 != 1, F.concat(F.lit("v2-"), text)).alias("etag"),
        F.concat(F.lit("day "), (key % 7).cast("string")).alias("last_modified"),
        content.alias("sha256"),
    )
    manifest = docs.where(key % 5 != 4).select(
        F.concat(F.lit("d"), text).alias("hospital_id"),
        F.concat(F.lit("landing/"), text).alias("path"),
        F.when(key % 5 == 0, F.concat(F.lit("v2-"), text)).otherwise("v1").alias("etag"),
        F.when(key % 5 == 1, F.concat(F.lit("day "), (key % 7).cast("string"))).alias("last_modified"),
        F.when(key % 5 == 3, F.sha2(F.lit("old").cast("binary"), 256)).otherwise(content).alias("sha256"),
        F.lit(None).cast("string").alias("error"),
    )
    return admission.admit(files, manifest).select("hospital_id", "sha256", "status")


_POWERS = "list_reduce([CAST(0 AS HUGEINT)] || list_transform(lines, lambda x: CAST(md5_number_{half}(x) AS HUGEINT)), lambda m, h: (m * {factor} + h) % {prime})"


@register(
    "line_fingerprints",
    f"""SELECT doc_id AS path, sha256(concat_ws('-', len(lines), {_POWERS.format(half="upper", factor=admission.FACTORS[0], prime=admission.PRIME)},
    {_POWERS.format(half="lower", factor=admission.FACTORS[1], prime=admission.PRIME)}, strlen(text))) AS sha256
    FROM (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents)""",
)
def _(spark, sf):
    """Content marks of texts taken as files of many blocks: the order of the lines counts, the block borders don't."""
    docs = sample_charges.table(spark, sf, "documents").select("doc_id", "text")
    lines = docs.select(F.col("doc_id").alias("path"), F.octet_length("text").alias("size"), F.posexplode(F.split("text", "\n")).alias("pos", "value"))
    # borders at different places of each text
    cut = lines.withColumn("block", F.floor((F.col("pos") + F.col("path") % 7) / 5))
    in_order = cut.repartition("path", "block").sortWithinPartitions("path", "block", "pos")
    return admission.content_marks(in_order).withColumn("path", F.col("path").cast("bigint"))
