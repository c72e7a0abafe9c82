"""SQL for payloads, tool calls, files and the catalog."""

COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
                "l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label", "pages": "page_id url html", "benchmark": "item_id text",
    "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}
LINES = """x AS (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents),
  b AS (SELECT doc_id, unnest(t) AS line, generate_subscripts(t, 1) - 1 AS i FROM x)"""

LATIN1 = "SELECT doc_id, length(text) AS n_chars, sha256(text) AS digest FROM documents"

ORACLES = {
    "json_payload_extract": """SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id::VARCHAR END AS location_id,
        value AS temp, CASE WHEN event_type NOT IN ('signup', 'error') THEN event_type END AS city,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN (props->>'k')::INT END AS k FROM events""",
    "props_extract": """SELECT event_type, count(props->>'k') AS n_k, sum((props->>'k')::INT)::BIGINT AS sum_k
        FROM events GROUP BY 1""",
    "tool_call_extract": """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS tool_name,
        CASE WHEN event_type IN ('click', 'view') THEN '{"k":' || CASE WHEN event_type = 'view' THEN ' ' ELSE '' END
          || (props->>'k') || '}' END AS arguments,
        CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'ok' WHEN 'error' THEN 'malformed' ELSE 'none' END
          AS call_status, CASE WHEN event_type IN ('click', 'view') THEN (props->>'k')::INT END AS k FROM events""",
    "tool_call_rounds": """SELECT conv_id, turn, role, (sum((role = 'assistant')::INT) OVER (PARTITION BY conv_id
        ORDER BY turn ROWS UNBOUNDED PRECEDING))::BIGINT AS round_no FROM conversations""",
    "row_validation": """SELECT event_id, CASE WHEN user_id IS NULL THEN 'missing_user'
        WHEN props->>'k' IS NULL THEN 'missing_k' WHEN ts::DATE <> (SELECT max(ts::DATE) FROM events) THEN 'not_today'
        WHEN NOT coalesce(value > 0, false) THEN 'no_value' END AS reject_reason FROM events""",
    "parsed_page_profile": f"""WITH {LINES} SELECT doc_id, (i // 5 + 1)::INT AS page_num, count(*) AS n_blocks,
        count(*) FILTER (contains(line, '|')) AS n_tables, sum(len(string_split(line, ' ')))::BIGINT AS n_tokens,
        round_even(avg(CASE WHEN contains(line, '|') THEN length(trim(line)) + 1 ELSE length(line) END), 2)
          AS mean_length, max(length(line) % 7 + 8)::INT AS max_font FROM b GROUP BY 1, 2""",
    "table_block_cells": rf"""WITH {LINES}, r AS (SELECT doc_id, (i // 5 + 1)::INT AS page_num, (i % 5)::INT AS block_no,
        string_split(regexp_replace('|' || trim(line), '^\||\|$', '', 'g'), '|') AS cells FROM b
        WHERE contains(line, '|'))
        SELECT doc_id, page_num, block_no, (generate_subscripts(cells, 1) - 1)::INT AS col_no,
          nullif(trim(unnest(cells)), 'None') AS cell FROM r""",
    "url_quoted": "SELECT page_id, replace(url_encode(url), '%2F', '/') AS quoted FROM pages",
    "catalog_snapshot": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS null_rate FROM {t}"
        for t, names in COLUMNS.items() for c in names.split()
    ),
    "table_columns": " UNION ALL ".join(
        f"""SELECT {i}::INT AS position, '{c}' AS column_name, CASE any_value(typeof({c})) WHEN 'VARCHAR' THEN 'string'
          WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(any_value(typeof({c}))) END AS data_type,
          count(*) AS n_rows FROM lineitem""" for i, c in enumerate(COLUMNS["lineitem"].split())
    ),
    "catalog_sketches": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS n_values, true AS near FROM {t}"
        for t in ("customer", "orders", "lineitem") for c in COLUMNS[t].split()
    ),
    "variant_payloads": """SELECT event_id AS id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS kind,
        CASE WHEN event_id % 5 <> 0 THEN (props->>'k')::INT END AS k, CASE WHEN event_id % 5 <> 0 THEN event_type END AS first_tag,
        CASE WHEN event_id % 5 <> 0 THEN event_id END AS tag_number FROM events
        WHERE event_id % 11 <> 0 AND (props IS NOT NULL OR event_id % 5 = 0)""",
    "variant_quarantine": """WITH w AS (SELECT '{"id":' || event_id || ',"kind":"' || event_type || '","props":' || props
          || ',"tags":["' || event_type || '",' || event_id || ']}' AS whole FROM events WHERE event_id % 11 = 0)
        SELECT substr(whole, 1, length(whole) - 3) AS raw FROM w WHERE whole IS NOT NULL""",
    "named_file": "SELECT n_name AS nation FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'",
    "sheet_counts": "SELECT 'orders' AS sheet, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
    "file_listing": "SELECT DISTINCT 'lang=' || lang AS folder, 'parquet' AS suffix FROM documents",
    "file_count": "SELECT count(DISTINCT lang) AS n_files FROM documents",
    "sheet_roundtrip": """SELECT 'customer' AS sheet, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier""",
    "partial_append": """SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
        UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""",
    "latin1_roundtrip": r"SELECT doc_id, regexp_replace(text, '[ \t\r\n]', '_', 'g') AS marked FROM documents",
    "latin1_texts": LATIN1,
    "latin1_ranges": LATIN1,
    "csv_roundtrip": "SELECT * FROM customer",
    "merged_text": r"""SELECT count(*) AS n_lines, sum(length(regexp_replace(regexp_replace(regexp_replace(text, '(.|\n)',
        '\1 ', 'g'), '[\r\n]+', ' ', 'g'), '\s+$', '')))::BIGINT AS n_chars FROM conversations""",
    "positive_negative": r"""SELECT CASE quality WHEN 1 THEN '0,1' ELSE '1,0' END AS label, count(*) AS n_lines,
        sum(length(regexp_replace(text, '[\r\n]+', ' ', 'g')))::BIGINT AS n_chars
        FROM documents JOIN labels USING (doc_id) GROUP BY 1""",
    "labelled_corpus": "SELECT 'lang=' || lang AS label, count(*) AS n_docs FROM documents GROUP BY 1",
    "report_lines": """SELECT '- ' || n_name || ': ' || count(*) AS line FROM customer
        JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "vector_store": """SELECT (label + 1)::INT AS page, count(*) AS n_chunks, sum(len(embedding))::BIGINT AS n_values,
        sum(length(text))::BIGINT AS n_chars FROM embeddings JOIN documents ON doc_id = vec_id GROUP BY 1""",
    "stream_moving_averages": """WITH d AS (SELECT event_type AS series, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2)
        SELECT series, day, n, round(CASE WHEN count(*) OVER w = 7 THEN avg(n) OVER w END, 6) AS moving_avg,
          round((n / lag(n) OVER (PARTITION BY series ORDER BY day)::DOUBLE - 1) * 100, 6) AS growth_pct
        FROM d WINDOW w AS (PARTITION BY series ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "stream_daily_totals": """SELECT ts::DATE AS day, count(*) AS n_events, sum(value::DECIMAL(18,2))::DOUBLE
        AS total_value, max(event_id) AS last_event FROM events GROUP BY 1""",
}

ORACLES["session_catalog"] = ORACLES["catalog_snapshot"]
