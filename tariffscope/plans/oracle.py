"""Reference SQL for the registered queries, for DuckDB on the same parquet tables.

Built from named fragments: ``sql(body, *names)`` puts the fragments a query needs in front of it.
"""

from __future__ import annotations

from tariffscope.operators import payers
from tariffscope.plans import sample_charges as S
from tariffscope.sources import seeds


def _text(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows: list[dict]) -> str:
    return ", ".join("(" + ", ".join(_text(v) for v in row.values()) + ")" for row in rows)


def _case(column: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


_CODES = ", ".join(f"{{'code': {_text(c)}, 'type': {_text(t)}}}" for c, t in S.item_codes())

_LINE_RULES = [dict(zip("abcd", (i, *rule), strict=True)) for i, rule in enumerate(payers.LINE_RULES)]

# (needs, body) per fragment, in the order they are put together.
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "patterns": (
        (),
        f"""SELECT CAST(pattern AS VARCHAR) AS pattern, payer_group, priority, CAST(product_line AS VARCHAR) AS product_line
        FROM (VALUES {_values(seeds.pattern_rows())}) v(pattern, payer_group, priority, product_line)""",
    ),
    "services": (
        (),
        f"""SELECT billing_code, billing_code_type, service_name, category
        FROM (VALUES {_values(seeds.service_rows())}) v(billing_code, billing_code_type, service_name, category)""",
    ),
    "hospital_files": (
        (),
        """SELECT 'h' || n_nationkey AS hospital_id, n_name || ' Hospital' AS hospital_name,
        CASE n_nationkey % 3 WHEN 0 THEN '7/' || (1 + n_nationkey) || '/2026'
             WHEN 1 THEN '2026-04-' || lpad(CAST(1 + n_nationkey AS VARCHAR), 2, '0') ELSE 'soon' END AS last_updated_on,
        '3.0.0' AS version,
        CASE WHEN n_nationkey % 4 <> 3 THEN ['100000' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0'),
             '200000' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0')] END AS type_2_npi,
        CAST(n_nationkey AS VARCHAR) AS license_number, 'CA' AS license_state,
        n_nationkey % 2 = 0 AS attestation_confirmed, n_name || '.csv' AS source_file,
        CASE WHEN n_nationkey % 2 = 0 THEN 'csv_tall' ELSE 'json' END AS source_format,
        CAST(n_nationkey AS BIGINT) * 100 AS row_count, TIMESTAMP '2026-09-27 17:07:51' AS parsed_at
        FROM nation""",
    ),
    "hospitals": (
        ("hospital_files",),
        """SELECT hospital_id, hospital_name,
        CAST(coalesce(try_strptime(last_updated_on, '%Y-%m-%d'), try_strptime(last_updated_on, '%m/%d/%Y')) AS DATE)
            AS last_updated_on,
        version AS schema_version, type_2_npi[1] AS type_2_npi, CAST(len(type_2_npi) AS BIGINT) AS npi_count,
        license_number, license_state, attestation_confirmed, source_file, source_format,
        row_count AS source_row_count, parsed_at FROM hospital_files""",
    ),
    "wide_rows": (
        (),
        f"""SELECT *, l_extendedprice / l_quantity AS rate, l_linenumber < 6 AS has_payer,
        l_linenumber % 4 = 0 AS percent_row, l_linenumber = 5 AND l_returnflag = 'R' AS formula,
        [{_CODES}][CAST(p_partkey % {S.CODE_SPACE} AS INTEGER) + 1] AS item_code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey""",
    ),
    "charges": (
        ("wide_rows",),
        f"""SELECT CASE WHEN p_partkey % 97 <> 0 THEN ' ' || p_name || ' #' || p_partkey END AS description,
        CASE WHEN p_partkey % 11 = 5 THEN [] ELSE [{{'code': '0' || (300 + p_partkey % 9), 'type': 'RC'}},
            {{'code': item_code.code, 'type': CASE WHEN p_partkey % 3 = 0 AND item_code.type = 'CPT' THEN 'HCPCS'
            ELSE item_code.type END}}] END AS codes,
        {_case("l_returnflag", S.SETTINGS, "'both'")} AS setting,
        CASE WHEN l_linestatus <> 'F' THEN '50' END AS modifiers,
        CASE WHEN l_linenumber IN (1, 7) THEN p_retailprice * 3 END AS gross_charge,
        CASE WHEN l_linenumber = 7 THEN p_retailprice * 2 END AS discounted_cash,
        p_retailprice AS min_charge, p_retailprice * 4 AS max_charge,
        CASE WHEN has_payer THEN (CASE WHEN c_nationkey % 7 = 0 THEN 'ZZZ' ELSE '' END) ||
            (CASE c_nationkey WHEN 3 THEN 'MEDICARE' WHEN 5 THEN 'MassHealth'
             ELSE {_case("c_mktsegment", S.SEGMENT_PAYERS)} END) || ' [' || (1200 + c_nationkey) || ']' END AS payer_name,
        CASE WHEN has_payer THEN {_case("o_orderpriority", S.PRIORITY_PLANS)} END AS plan_name,
        CASE WHEN has_payer AND NOT percent_row AND NOT formula THEN rate END AS negotiated_dollar,
        CASE WHEN has_payer AND percent_row THEN l_discount * 1000 END AS negotiated_percentage,
        CASE WHEN has_payer AND (formula OR percent_row) THEN 'per contract, see exhibit' END AS negotiated_algorithm,
        CASE WHEN has_payer THEN {_case("l_linenumber % 3", dict(enumerate(S.METHODS)))} END AS methodology,
        CASE WHEN has_payer AND l_tax > 0.04 THEN rate * 0.9 END AS median_amount,
        CASE WHEN has_payer AND l_tax > 0.04 THEN rate * 0.9 * 0.5 END AS p10_amount,
        CASE WHEN has_payer AND l_tax > 0.04 THEN rate * 0.9 * 1.5 END AS p90_amount,
        CASE WHEN has_payer AND l_tax > 0.04 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS allowed_count,
        CASE WHEN has_payer AND (formula OR percent_row) THEN rate * 0.75 END AS estimated_amount,
        CASE WHEN p_partkey % 13 = 2 THEN '10.5' END AS drug_unit, CASE WHEN p_partkey % 13 = 2 THEN 'ML' END AS drug_unit_type,
        CASE WHEN l_linenumber = 2 THEN 'Size 9" x 1", see "' || p_name || '"' END AS notes,
        'h' || (l_suppkey % 5) AS hospital_id FROM wide_rows""",
    ),
    "staged": (
        ("charges",),
        """SELECT hospital_id, trim(description) AS description, codes, lower(trim(setting)) AS setting, modifiers,
        trim(payer_name) AS payer_name, trim(plan_name) AS plan_name, gross_charge, discounted_cash, min_charge,
        max_charge, negotiated_dollar, negotiated_percentage, negotiated_algorithm,
        lower(trim(methodology)) AS methodology, median_amount, p10_amount, p90_amount, allowed_count,
        estimated_amount FROM charges WHERE description IS NOT NULL""",
    ),
    "picked": (
        ("staged",),
        """SELECT *, coalesce(list_filter(codes, lambda c: c.type = 'CPT' OR c.type = 'HCPCS')[1],
        list_filter(codes, lambda c: c.type = 'MS-DRG')[1]) AS pick FROM staged""",
    ),
    "coded": (
        ("picked",),
        """SELECT * EXCLUDE (pick),
        CASE WHEN pick.type = 'MS-DRG' THEN ltrim(pick.code, '0') ELSE upper(pick.code) END AS billing_code,
        CASE WHEN pick.type = 'HCPCS' AND regexp_full_match(pick.code, '[0-9]{4}[0-9A-Z]') THEN 'CPT'
             ELSE pick.type END AS billing_code_type,
        coalesce(array_to_string(list_sort(list_transform(codes, lambda c: c.type || ':' || c.code)), ','), '')
            AS code_signature FROM picked""",
    ),
    "pairs": (("staged",), "SELECT DISTINCT payer_name, plan_name FROM staged WHERE payer_name IS NOT NULL"),
    "cleansed": (
        ("pairs",),
        r"""SELECT *, regexp_replace(regexp_replace(payer_name, '\s*\[[0-9]+\]\s*$', ''), '^ZZZ', '')
        AS payer_display_name, starts_with(lower(payer_name), 'zzz') AS is_retired_payer FROM pairs""",
    ),
    "candidates": (
        ("cleansed", "patterns"),
        """SELECT payer_name, plan_name, payer_group, product_line AS product_line_override, priority,
        CAST(length(pattern) AS INTEGER) AS specificity, match_source, pattern
        FROM (SELECT payer_name, plan_name, unnest([1, 2]) AS match_source,
              unnest([lower(payer_display_name), lower(coalesce(plan_name, ''))]) AS searched FROM cleansed)
        JOIN patterns ON searched LIKE pattern""",
    ),
    "best": (
        ("candidates",),
        """SELECT payer_name, plan_name, unnest(arg_min(
            {'payer_group': payer_group, 'product_line_override': product_line_override, 'match_source': match_source},
            {'source': match_source, 'priority': priority, 'shortness': -specificity, 'pattern': pattern}))
        FROM candidates GROUP BY payer_name, plan_name""",
    ),
    "line_rules": (
        (),
        f"SELECT * FROM (VALUES {_values(_LINE_RULES)}) v(rank, side, words, line)",
    ),
    "lines": (
        ("cleansed", "line_rules"),
        """SELECT payer_name, plan_name, min_by(line, rank) AS line FROM cleansed JOIN line_rules
        ON regexp_matches(lower(CASE side WHEN 'plan' THEN coalesce(plan_name, '') ELSE payer_display_name END), words)
        GROUP BY payer_name, plan_name""",
    ),
    "payers": (
        ("cleansed", "best", "lines"),
        """SELECT md5(payer_name || '|' || coalesce(plan_name, '')) AS payer_key, payer_name, plan_name,
        any_value(payer_display_name) AS payer_display_name, any_value(is_retired_payer) AS is_retired_payer,
        coalesce(any_value(payer_group), 'Other') AS payer_group, any_value(match_source) AS match_source,
        coalesce(any_value(product_line_override), any_value(line), 'Commercial') AS product_line
        FROM (FROM cleansed UNION ALL BY NAME FROM best UNION ALL BY NAME FROM lines) GROUP BY payer_name, plan_name""",
    ),
    "item_prices": (
        ("coded",),
        """SELECT hospital_id, description, code_signature, setting, modifiers, max(gross_charge) AS gross_charge,
        max(discounted_cash) AS discounted_cash FROM coded GROUP BY ALL""",
    ),
    "item_prices_any": (
        ("coded",),
        """SELECT hospital_id, description, code_signature, modifiers, max(gross_charge) AS gross_charge,
        max(discounted_cash) AS discounted_cash FROM coded GROUP BY ALL""",
    ),
    "code_prices": (
        ("coded",),
        """SELECT hospital_id, billing_code, billing_code_type, median(gross_charge) AS gross_charge,
        median(discounted_cash) AS discounted_cash FROM coded
        WHERE billing_code IS NOT NULL AND gross_charge IS NOT NULL GROUP BY ALL""",
    ),
    "priced": (
        ("coded", "services"),
        """SELECT * EXCLUDE (gross_charge, discounted_cash), [
            {'match': 'same item', 'gross': max(gross_charge) OVER same, 'cash': max(discounted_cash) OVER same},
            {'match': 'same item, other setting', 'gross': max(gross_charge) OVER item, 'cash': max(discounted_cash) OVER item},
            {'match': 'same billing code', 'gross': CASE WHEN billing_code IS NOT NULL THEN median(gross_charge) OVER code END,
             'cash': CASE WHEN billing_code IS NOT NULL THEN median(discounted_cash) FILTER (gross_charge IS NOT NULL) OVER code END}
        ] AS levels,
        EXISTS (FROM services s WHERE s.billing_code = coded.billing_code AND s.billing_code_type = coded.billing_code_type)
            AS is_shoppable
        FROM coded WINDOW item AS (PARTITION BY hospital_id, description, code_signature, modifiers),
        same AS (PARTITION BY hospital_id, description, code_signature, modifiers, setting),
        code AS (PARTITION BY hospital_id, billing_code, billing_code_type)""",
    ),
    "fact": (
        ("priced",),
        """SELECT md5(concat_ws('|', hospital_id, description, code_signature, setting, modifiers, payer_name, plan_name))
            AS rate_key,
        hospital_id, billing_code, billing_code_type, description, setting, modifiers,
        md5(payer_name || '|' || coalesce(plan_name, '')) AS payer_key, code_signature,
        found.gross AS gross_charge, list_filter(levels, lambda x: x.cash IS NOT NULL)[1].cash AS discounted_cash,
        found.match AS list_price_match, negotiated_dollar, negotiated_percentage, negotiated_algorithm,
        CASE WHEN negotiated_dollar IS NULL THEN negotiated_percentage / 100.0 * found.gross ELSE negotiated_dollar END
            AS effective_rate,
        list_filter([{'has': negotiated_dollar IS NOT NULL, 'source': 'dollar'},
            {'has': negotiated_percentage + found.gross IS NOT NULL, 'source': 'derived_from_percentage'},
            {'has': negotiated_algorithm IS NOT NULL, 'source': 'algorithm_only'}], lambda x: x.has)[1].source AS rate_source,
        methodology, median_amount, p10_amount, p90_amount, allowed_count, is_shoppable
        FROM (SELECT *, list_filter(levels, lambda x: x.gross IS NOT NULL)[1] AS found FROM priced WHERE payer_name IS NOT NULL)""",
    ),
    "rates": (
        ("fact", "services", "hospitals", "payers"),
        """SELECT category, service_name, billing_code, hospital_name, payer_group, product_line, effective_rate,
        median_amount, gross_charge, discounted_cash,
        starts_with(methodology, 'percent') OR rate_source = 'derived_from_percentage' AS is_percent, methodology
        FROM (FROM fact WHERE is_shoppable AND effective_rate IS NOT NULL) JOIN services USING (billing_code, billing_code_type)
        JOIN (FROM payers WHERE NOT is_retired_payer) USING (payer_key) JOIN hospitals USING (hospital_id)""",
    ),
    "mart": (
        ("rates",),
        """SELECT category, service_name, billing_code, hospital_name, payer_group, product_line,
        CAST(len(agreed) AS BIGINT) AS plan_rates, agreed[1] AS min_rate, round(list_median(agreed), 2) AS median_rate,
        agreed[-1] AS max_rate, round(list_median(paid), 2) AS median_actually_paid,
        listed[-1] AS gross_charge, cash[-1] AS cash_price, includes_percentage_rates
        FROM (SELECT category, service_name, billing_code, hospital_name, payer_group, product_line,
              list(effective_rate ORDER BY effective_rate) AS agreed, list(median_amount) AS paid,
              list(gross_charge ORDER BY gross_charge NULLS FIRST) AS listed,
              list(discounted_cash ORDER BY discounted_cash NULLS FIRST) AS cash,
              bool_or(is_percent) AS includes_percentage_rates FROM rates GROUP BY ALL)""",
    ),
    "benchmarked": (
        ("mart",),
        """SELECT mart.*, round(100.0 * median_rate / CASE WHEN medicare <> 0 THEN medicare END, 0) AS pct_of_medicare
        FROM mart LEFT JOIN (SELECT billing_code, hospital_name, list_median(list(median_rate)) AS medicare FROM mart
            WHERE product_line = 'Medicare (traditional)' GROUP BY billing_code, hospital_name) USING (billing_code, hospital_name)""",
    ),
    "hospital_medians": (
        ("mart",),
        """SELECT category, service_name, billing_code, hospital_name, round(median(median_rate), 2) AS m
        FROM mart WHERE product_line = 'Commercial' GROUP BY ALL""",
    ),
    "dispersion": (
        ("hospital_medians",),
        """SELECT category, service_name, billing_code, count(*) AS hospitals, min(m) AS lowest_hospital_median,
        max(m) AS highest_hospital_median,
        min(struct_pack(m := m, h := hospital_name)).h AS lowest_hospital,
        max(struct_pack(m := m, h := hospital_name)).h AS highest_hospital,
        round(max(m) / nullif(min(m), 0), 2) AS high_to_low_ratio
        FROM hospital_medians GROUP BY category, service_name, billing_code HAVING count(*) >= 2""",
    ),
    "summary": (
        ("mart",),
        """SELECT billing_code, product_line, hospital_name, min(min_rate) AS lowest_rate, max(max_rate) AS highest_rate,
        median(median_rate) AS hospital_median, first(cash_price ORDER BY payer_group) AS cash_price,
        first(gross_charge ORDER BY payer_group) AS gross_charge FROM mart GROUP BY ALL""",
    ),
}


def sql(body: str, *names: str) -> str:
    """``body`` with all fragments it needs as CTEs, each once, in dependency order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for need in FRAGMENTS[name][0]:
                add(need)

    for name in names:
        add(name)
    parts = [f"{n} AS (\n{FRAGMENTS[n][1]}\n)" for n in FRAGMENTS if n in wanted]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body


def whole(name: str, columns: str = "*") -> str:
    return sql(f"SELECT {columns} FROM {name}", name)
