"""DuckDB SQL equivalents of the stand-ins, over the driver's pre-registered views.

Column names and types line up with :mod:`ingot.plans.standins`.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S.%f'"

_EVENT_KINDS = """
SELECT 'event_id' AS path, 'INTEGER' AS type, 'NULLABLE' AS mode, count(*) AS n FROM {src}
UNION ALL SELECT 'ts', 'TIMESTAMP', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'user_id', 'INTEGER', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'event_type', 'STRING', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'value', 'FLOAT', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'props', 'RECORD', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'props.k', 'INTEGER', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'tags', 'STRING', 'REPEATED', count(*) FROM {src}
UNION ALL SELECT 'note', 'STRING', 'NULLABLE', count(*) FROM {src}
UNION ALL SELECT 'code',
    CASE WHEN bool_and(event_type = 'view') THEN 'INTEGER' ELSE 'STRING' END, 'NULLABLE', count(*) FROM {src}
"""

SQL: dict[str, str] = {
    "flagship_ingest": """
SELECT 'orders/o_orderstatus=' || o_orderstatus AS rel_path, count(*) AS actual, count(*) AS expected,
       'OK' AS status,
       count(*) FILTER (WHERE NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P')) AS published,
       CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 2 ELSE 1 END)
            FILTER (WHERE NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P')) AS BIGINT) AS apc_entries
FROM orders GROUP BY o_orderstatus
""",
    "works_convert": """
WITH li AS (
  SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linestatus <> 'O') AS n_issn,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_oa
  FROM lineitem GROUP BY l_orderkey)
SELECT 'W' || o_orderkey AS id,
       CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN 2 ELSE 1 END AS BIGINT) AS n_apc,
       CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN NULL
            ELSE CAST(floor(o_totalprice) AS BIGINT) END AS apc_first_value,
       coalesce(li.n, 1) AS n_locations, coalesce(li.n_issn, 0) AS n_issn, coalesce(li.n_oa, 0) AS n_oa,
       CASE WHEN o_orderstatus = 'F' THEN 'S' || o_custkey END AS pl_source_id,
       o_orderstatus = 'F' AS pl_is_oa, CAST(0 AS BIGINT) AS pl_n_issn,
       o_orderstatus = 'O' AS boa_is_oa, o_orderstatus <> 'O' AS boa_has_source,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS BIGINT) AS n_authorships,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS BIGINT) AS n_inst,
       CAST(0 AS BIGINT) AS n_lineage,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS BIGINT) AS n_aff_ids,
       CAST(0 AS BIGINT) AS n_countries,
       CASE WHEN o_orderpriority = '1-URGENT' OR c_acctbal < 0 THEN NULL ELSE 'I' || n_nationkey END AS inst_id,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS BIGINT) AS n_referenced,
       '{"' || o_orderpriority || '":[0]}' AS abstract_json,
       '{"x":' || o_orderkey || ',"y":[1,null]}' AS brand_new, '"' || o_custkey || '"' AS cited_text,
       '2024-01-05T10:11:12.123456' AS updated_text, o_orderstatus AS ids_newid,
       CASE WHEN o_orderstatus = 'O' THEN 'gold' END AS oa_status
FROM orders LEFT JOIN li ON li.l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
""",
    "sources_convert": """
SELECT 'S' || s_suppkey AS id,
       CAST(CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END AS BIGINT) AS n_issn,
       CAST(2 AS BIGINT) AS n_alternate_titles, CAST(1 AS BIGINT) AS n_apc_prices,
       CAST(floor(s_acctbal) AS BIGINT) AS first_price, CAST(1 AS BIGINT) AS n_topics,
       CAST(0 AS BIGINT) AS n_counts_by_year, CAST(0 AS BIGINT) AS n_lineage, true AS ids_issn_null,
       '[{"m":null,"n":"' || s_suppkey || '"}]' AS new_list
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
""",
    "institutions_convert": """
SELECT 'I' || c_custkey AS id, substr(n_name, 1, 2) AS country_code, c_custkey AS works_count,
       'https://img/' || c_custkey AS image_url, substr(n_name, 1, 2) AS geo_country_code,
       c_mktsegment AS geo_city, substr(n_name, 1, 2) AS assoc_country_code, n_name AS assoc_display_name,
       c_custkey AS geo_extra, '[{"works_count":"' || c_custkey || '","year":2020}]' AS counts_text,
       'associated_institutions,country_code,counts_by_year,display_name,display_name_acronyms,geo,id,image_url,works_count' AS top_keys
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
""",
    "ndjson_scan": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {TS}) AS o_orderdate,
       o_orderpriority, 'o_orderstatus=' || o_orderstatus AS folder
FROM orders
""",
    "ndjson_tolerant": """
SELECT doc_id, lang, source, n_chars, text FROM documents WHERE doc_id % 17 <> 0
""",
    "bad_record_report": """
SELECT 'source=' || source AS folder,
       count(*) FILTER (WHERE doc_id % 17 <> 0) AS n_good,
       count(*) FILTER (WHERE doc_id % 17 = 0) AS n_bad,
       count(*) FILTER (WHERE doc_id % 17 = 0) > 5 AS over_limit
FROM documents GROUP BY source
""",
    "quoted_numbers": f"""
SELECT event_id, strftime(ts, {TS}) AS ts,
       CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
       value, event_type, event_id % 101 = 0 AS bad
FROM events
""",
    "unknown_fields": """
WITH k AS (
  SELECT event_id, unnest(json_keys(props) || CASE WHEN event_type = 'error' THEN ['trace'] ELSE [] END) AS key
  FROM events),
u AS (
  SELECT event_id, string_agg(key, ',' ORDER BY key) AS uk, count(*) AS n FROM k
  WHERE key NOT IN ('event_id', 'ts', 'user_id', 'event_type', 'value') GROUP BY event_id)
SELECT e.event_id, coalesce(u.uk, '') AS unknown_keys, coalesce(u.n, 0) AS n_unknown, coalesce(u.n, 0) > 0 AS bad
FROM events e LEFT JOIN u ON u.event_id = e.event_id
""",
    "manifest_entries": """
SELECT 'lineitem' AS dataset,
       'lineitem/l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus || '/part-0.json.gz' AS rel_path,
       count(*) AS expected, (SELECT count(*) FROM lineitem) AS total
FROM lineitem GROUP BY l_returnflag, l_linestatus
""",
    "file_counts": """
SELECT 'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus AS folder, count(*) AS n_lines
FROM lineitem GROUP BY l_returnflag, l_linestatus
""",
    "validate_files": """
WITH g AS (SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1, 2),
o AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)
SELECT 'lineitem/l_returnflag=' || f || '/l_linestatus=' || s AS rel_path, n AS actual,
       n + CASE WHEN f = 'N' THEN 1 ELSE 0 END AS expected,
       CASE WHEN f = 'N' THEN 'MISMATCH' ELSE 'OK' END AS status
FROM g
UNION ALL
SELECT 'lineitem/l_returnflag=' || f || '/l_linestatus=Z', NULL, CAST(sum(n) AS BIGINT), 'FILE NOT FOUND' FROM g GROUP BY f
UNION ALL
SELECT 'orders/o_orderstatus=' || s, n, n, 'OK' FROM o
""",
    "validate_summary": """
WITH g AS (SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT 'lineitem' AS dataset, CAST(sum(n) AS BIGINT) AS actual, CAST(sum(n) AS BIGINT) AS expected,
       count(*) FILTER (WHERE f <> 'N') AS n_ok, count(*) FILTER (WHERE f = 'N') AS n_mismatch,
       (SELECT count(DISTINCT f) FROM g) AS n_missing, CAST(0 AS BIGINT) AS missing_records, 'FAIL' AS verdict
FROM g
UNION ALL
SELECT 'orders', count(*), count(*), count(DISTINCT o_orderstatus), 0, 0, 0, 'PASS' FROM orders
""",
    "pending_any_status": """
SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""",
    "pending_retry_failed": """
SELECT doc_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)
""",
    "pending_first_n": """
SELECT source, doc_id, rn FROM (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
  FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1))
WHERE rn <= 5
""",
    "ledger_union": """
WITH old AS (SELECT d.source, CASE WHEN l.quality = 1 THEN 'OK' ELSE 'FAIL' END AS status, 'old' AS run
             FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
new AS (SELECT source, CASE WHEN lang = 'de' THEN 'FAIL' ELSE 'OK' END AS status, 'new' AS run
        FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)),
u AS (SELECT * FROM old UNION ALL SELECT * FROM new)
SELECT source,
       count(*) FILTER (WHERE run = 'new' AND status = 'OK') AS uploaded_ok,
       count(*) FILTER (WHERE run = 'new' AND status = 'FAIL') AS upload_failed,
       count(*) FILTER (WHERE run = 'old' AND status = 'OK') AS skipped,
       count(*) AS ledger_rows
FROM u GROUP BY source
""",
    "batch_range": """
WITH r AS (SELECT source, dense_rank() OVER (ORDER BY source) AS folder_rank FROM (SELECT DISTINCT source FROM documents))
SELECT d.doc_id, d.source, r.folder_rank FROM documents d JOIN r ON r.source = d.source
WHERE r.folder_rank BETWEEN 2 AND 5
""",
    "folder_count": """
SELECT lang, count(DISTINCT source) AS n_folders FROM documents GROUP BY lang
""",
    "sample_head": """
SELECT event_type, event_id, rn FROM (
  SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
WHERE rn <= 100
""",
    "ensure_array": """
SELECT o_orderkey, count(l_orderkey) AS n_lines, CAST(max(l_linenumber) AS BIGINT) AS max_line
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""",
    "placeholder_array": """
SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""",
    "object_or_array": """
SELECT event_id, CAST(CASE WHEN event_type = 'click' THEN 2 ELSE 1 END AS BIGINT) AS n_elems,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL
            ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS first_k
FROM events
""",
    "struct_default": """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name END AS nation_name,
       NOT (c_acctbal < 0) AS nation_known,
       CAST(CASE WHEN c_acctbal < 0 OR n_regionkey = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_aliases
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "nested_array_repair": """
WITH lf AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus,
         CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'N' THEN l_returnflag
              ELSE l_returnflag || ',' || l_linestatus END AS ftxt,
         CASE WHEN l_linestatus = 'O' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS nf
  FROM lineitem)
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE count(lf.l_orderkey) END AS n_lines,
       CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE coalesce(sum(nf), 0) END AS BIGINT) AS n_flags,
       CASE WHEN o_orderpriority = '5-LOW' THEN ''
            ELSE coalesce(string_agg(ftxt, ',' ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus), '') END AS flags_text
FROM orders LEFT JOIN lf ON lf.l_orderkey = o_orderkey
GROUP BY o_orderkey, o_orderpriority
""",
    "compact_arrays": """
WITH lf AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, l_linestatus = 'O' AS null_flags,
         CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'N' THEN l_returnflag
              ELSE l_returnflag || ',' || l_linestatus END AS ftxt,
         CASE WHEN l_linestatus = 'O' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS nf
  FROM lineitem)
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE count(lf.l_orderkey) END AS n_lines,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE count(*) FILTER (WHERE null_flags) END AS n_null_flags,
       CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE coalesce(sum(nf), 0) END AS BIGINT) AS n_flags,
       CASE WHEN o_orderpriority = '5-LOW' THEN ''
            ELSE coalesce(string_agg(ftxt, ',' ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus), '') END AS flags_text
FROM orders LEFT JOIN lf ON lf.l_orderkey = o_orderkey
GROUP BY o_orderkey, o_orderpriority
""",
    "rename_keys": """
SELECT c_custkey, c_name, n_name, CAST(n_nationkey AS BIGINT) AS n_nationkey, c_mktsegment AS tag
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "drop_fields": """
SELECT o_orderkey, o_orderpriority AS intl_code_nested, 'lines,meta,o_orderkey,o_orderstatus' AS top_fields,
       'flags,l_linenumber,l_linestatus,l_partkey,l_returnflag' AS line_fields
FROM orders
""",
    "stringify_map": """
SELECT event_id, CASE WHEN event_type = 'signup' THEN '{}' WHEN event_type = 'error' THEN NULL
                      ELSE CAST(json(props) AS VARCHAR) END AS props_text
FROM events
""",
    "text_index_build": """
WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
                  generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents)
SELECT doc_id, word, count(*) AS n_pos, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM t GROUP BY doc_id, word
""",
    "text_reconstruct": """
SELECT doc_id, text FROM documents
""",
    "contract_check": """
WITH rec AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, count(l_orderkey) AS nl,
         count(*) FILTER (WHERE l_linestatus = 'O') AS n_null_flags,
         count(*) FILTER (WHERE l_linestatus <> 'O' AND l_returnflag = 'N') AS n_null_elem
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_orderpriority, o_orderstatus),
r AS (SELECT *, o_orderpriority = '5-LOW' OR nl = 0 AS lines_null FROM rec)
SELECT 'lines' AS "column", count(*) FILTER (WHERE lines_null) AS null_arrays,
       count(*) FILTER (WHERE NOT lines_null AND o_orderstatus = 'F') AS null_elements, CAST(0 AS BIGINT) AS null_structs
FROM r
UNION ALL
SELECT 'lines.flags', count(*) FILTER (WHERE NOT lines_null AND n_null_flags > 0),
       count(*) FILTER (WHERE NOT lines_null AND n_null_elem > 0), 0 FROM r
UNION ALL
SELECT 'ship', 0, 0, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') FROM r
UNION ALL
SELECT 'ship.codes', 0, 0, 0
""",
    "schema_profile": _EVENT_KINDS.format(src="events"),
    "schema_merge": f"""
WITH rest AS (SELECT * FROM events WHERE event_type NOT IN ('view', 'click')),
k AS ({_EVENT_KINDS.format(src="rest")})
SELECT path, CASE WHEN path = 'code' THEN CASE WHEN (SELECT bool_and(event_type = 'view') FROM events)
                                               THEN 'INTEGER' ELSE 'STRING' END ELSE type END AS type,
       mode, n
FROM k
""",
    "schema_drift": """
WITH e AS (SELECT count(*) AS n, bool_and(event_type = 'view') AS all_view FROM events)
SELECT path, change, old_type, new_type, old_mode, new_mode FROM (
  SELECT 'channel' AS path, 'added' AS change, NULL AS old_type, 'STRING' AS new_type, NULL AS old_mode, 'NULLABLE' AS new_mode
  UNION ALL SELECT 'props.key', 'added', NULL, 'INTEGER', NULL, 'NULLABLE'
  UNION ALL SELECT 'props.k', 'removed', 'INTEGER', NULL, 'NULLABLE', NULL
  UNION ALL SELECT 'note', 'removed', 'STRING', NULL, 'NULLABLE', NULL
  UNION ALL SELECT 'user_id', 'type_changed', 'INTEGER', 'STRING', 'NULLABLE', 'NULLABLE'
  UNION ALL SELECT 'code', 'type_changed', 'STRING', 'INTEGER', 'NULLABLE', 'NULLABLE'
), e WHERE e.n > 0 AND NOT (path = 'code' AND e.all_view)
""",
    "unknown_paths": """
SELECT 'channel' AS path, count(*) AS n FROM events
UNION ALL SELECT 'props.key', count(*) FROM events
""",
    "schema_resolve": """
WITH cat AS (
  SELECT DISTINCT event_type AS dataset, strftime(ts, '%Y%m%d') AS version,
         CAST(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS pattern_rank
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset
                                   ORDER BY (version = '20240115') DESC, version DESC, pattern_rank ASC) AS rn
      FROM cat)
SELECT dataset, version, pattern_rank,
       'schemas/' || version || '/' || dataset || CASE WHEN pattern_rank = 1 THEN '.schema.json' ELSE '_schema.json' END AS path
FROM r WHERE rn = 1
""",
    "table_publish": """
SELECT o_orderstatus, count(*) AS n_orders, round(sum(o_totalprice), 2) AS sum_totalprice FROM orders GROUP BY 1
""",
    "intake_stream": """
SELECT l_returnflag, CAST(CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 2 END AS BIGINT) AS run,
       count(*) AS n_records, count(*) AS ledger_records, CAST(0 AS BIGINT) AS ledger_dropped
FROM lineitem GROUP BY l_returnflag
UNION ALL
SELECT 'bad', 3, 0, 0, 1
""",
}
