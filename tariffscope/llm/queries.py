"""Registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffscope.llm import (
    chat_repair,
    decontaminate,
    html_text,
    jaccard_join,
    license_scan,
    mixing,
    piece_codec,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_links,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.drop_repeated_windows(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeated_bytes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("matches")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = quality_rules.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}
    return mixing.mix(_table(spark, sf_dir, "documents"), dimensions=dimensions)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repaired(chat_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_links.token_links(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"), with_groups=False)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_codec.encode(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "as_library",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_decontaminate, op2_jaccard_join, op3_substring_dedup, op4_suffix_dedup, op5_html_text,
        op6_license_scan, op7_quality_rules, op8_mixing, op9_sharding, op10_secret_scan, op11_chat_repair,
        op12_token_links, op13_sentencepiece,
    )
    return {f.__name__: f for f in own}


_WORDS = """SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM
    (SELECT doc_id, list_filter(regexp_split_to_array({text}, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS ws FROM documents)"""

_OP2 = f"""
WITH RECURSIVE words AS ({_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}),
runs AS (SELECT doc_id, string_agg(x, ' ') OVER f AS k, count(*) OVER f AS n, i, count(*) OVER (PARTITION BY doc_id) AS total
         FROM words WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
sets AS (SELECT DISTINCT doc_id, k FROM runs WHERE n = 5 OR (total < 5 AND i = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.y FROM reach r JOIN both_ways l ON l.x = r.b)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) m USING (doc_id)
"""

_OP3 = f"""
WITH words AS ({_WORDS.format(text="coalesce(text, '')")}),
runs AS (SELECT doc_id, i, string_agg(x, ' ') OVER f AS k, count(*) OVER f AS n
         FROM words WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM runs WHERE n = 20),
gone AS (SELECT DISTINCT doc_id, i + d AS i, 1 AS g FROM ranked, range(20) t(d) WHERE r > 1),
marked AS (SELECT w.doc_id, w.i, w.x, g.g FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i),
told AS (SELECT doc_id, count(*) AS n_words, count(g) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (g IS NULL) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN told USING (doc_id)
"""


# the checksum by its rule: a byte at a time, eight shifts each
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii({text}[i]) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""

_OP11 = f"""
WITH RECURSIVE convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
named AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations JOIN convs USING (conv_id)),
kinds AS (SELECT *, {_CRC32.format(text="k")} % 20 AS kind FROM named),
harmed AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
    ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM harmed),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ \t\n\v\f\r]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^ \t\n\v\f\r])[ \t\n\v\f\r]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    role[1] AS initial, lag(role[1]) OVER (PARTITION BY c ORDER BY i) || role[1] AS pair FROM rows_),
told AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
    count_if(fault = 'truncated') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM judged GROUP BY c),
-- rows put in before one: state, their number, state then, the rows
put AS (FROM (VALUES (0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
    (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']), (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])) v(p, n, m, lines)),
edits AS (SELECT c, i, m, unnest([{{'letter': 'D', 'cost': 3, 'q': m, 'lines': CAST([] AS VARCHAR[])}},
    {{'letter': 'K', 'cost': CAST(fault = 'truncated' AS INTEGER), 'q': CASE WHEN fault IN ('', 'truncated') THEN CASE WHEN initial = 's' AND m = 0 THEN 1
        WHEN initial = 'u' AND m <> 2 THEN 2 WHEN initial = 'a' AND m = 2 THEN 3 END END, 'lines': [role || ':' || text]}},
    {{'letter': 'R', 'cost': 2 + CAST(fault = 'truncated' AS INTEGER), 'q': CASE WHEN fault IN ('', 'truncated') THEN CASE WHEN m = 2 THEN 3 ELSE 2 END END,
        'lines': [CASE WHEN m = 2 THEN 'assistant:' ELSE 'user:' END || text]}}]) AS e FROM judged, range(4) r(m)),
best AS (SELECT c, CAST(0 AS BIGINT) AS i, CAST(0 AS INTEGER) AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM convs
    UNION ALL
    SELECT c, i, q, k.cost, k.audit, lines FROM (SELECT c, i, q, min(k) AS k, arg_min(lines, k) AS lines FROM (
        SELECT b.c, e.i, CAST(e.e.q AS INTEGER) AS q, {{'cost': CAST(b.cost + 2 * put.n + e.e.cost AS BIGINT), 'audit': b.audit || repeat('I', put.n) || e.e.letter}} AS k,
            b.lines || put.lines || e.e.lines AS lines
        FROM best b JOIN put ON put.p = b.state JOIN edits e ON e.c = b.c AND e.i = b.i + 1 AND e.m = put.m WHERE e.e.q IS NOT NULL) GROUP BY c, i, q)),
closed AS (SELECT c, min(k) AS k, arg_min(lines, k) AS lines FROM (SELECT b.c, {{'cost': b.cost + 2 * put.n, 'audit': b.audit || repeat('I', put.n)}} AS k, b.lines || put.lines AS lines
    FROM best b JOIN put ON put.p = b.state LEFT JOIN told USING (c) WHERE b.i = coalesce(told.n, 0) AND put.m IN (0, 3)) GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, k.cost AS cost, k.audit AS audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM convs JOIN closed USING (c) LEFT JOIN told USING (c)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": _OP2, "op3_substring_dedup": _OP3, "op11_chat_repair": _OP11}
