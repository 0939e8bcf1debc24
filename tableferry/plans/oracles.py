"""The same answers in plain SQL over the given tables, by query name."""

from __future__ import annotations

_LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_POINT = "concat('POINT (', c_nationkey, ' ', c_custkey % 90, ')')"

ORACLES: dict[str, str] = {
    "read_table": "SELECT * FROM customer",
    "read_select": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "read_where": "SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'",
    "read_where_tail": """SELECT * FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "read_cte": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "read_where_subselect": """SELECT * FROM customer WHERE c_nationkey IN
        (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""",
    "filter_frame": "SELECT * FROM lineitem WHERE l_quantity >= 45 AND l_discount = 0",
    "materialize": "SELECT * FROM events",
    "sql_join_agg": """SELECT n.n_name, count(*) AS order_count,
        CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",
    "sql_window_topk": """SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM orders) t WHERE rn <= 3""",
    "sql_set_ops": """SELECT c_custkey AS k FROM customer
        EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
    "sql_params": """SELECT * FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 250000""",
    "list_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
        for t in ("customer", "lineitem", "orders")
    ),
    "list_columns": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS n FROM lineitem"
        for i, c in enumerate(_LINEITEM, start=1)
    ),
    "write_append_name": """SELECT * FROM customer
        UNION ALL SELECT * FROM customer WHERE c_acctbal < 0""",
    "write_append_position": """SELECT c_custkey, c_name, c_nationkey FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
    "write_replace": "SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders",
    "write_fail_existing": "SELECT * FROM supplier",
    "write_ignore_existing": "SELECT * FROM part",
    "upload_lite": "SELECT c_custkey AS cust_key, c_name AS name FROM customer",
    "upload_typed": """SELECT row_number() OVER (ORDER BY p_partkey) AS id, p_partkey, p_name,
        CAST(p_size AS VARCHAR) AS p_size,
        CAST(CAST(p_retailprice AS REAL) AS DOUBLE) AS p_retailprice FROM part""",
    "upload_full": """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey AS cust_key,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS market_segment_
        FROM customer""",
    "upload_wkt": """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey, 4326 AS srid,
        CAST(c_nationkey AS DOUBLE) AS x, CAST(c_custkey % 90 AS DOUBLE) AS y FROM customer""",
    "insert_values": """SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey AS k,
        o_totalprice AS price, o_orderstatus AS status FROM orders
        UNION ALL SELECT (SELECT count(*) FROM orders) + n, k, price, status
        FROM (VALUES (1, 70, 12.5, 'new'), (2, 80, 25.0, 'old')) t(n, k, price, status)""",
    "create_empty": """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey AS k,
        CAST(CAST(c_acctbal AS REAL) AS DOUBLE) AS balance, c_name AS name FROM customer""",
    "create_if_absent_keeps_rows": "SELECT * FROM supplier",
    "delete_where": """SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
        FROM orders) t WHERE NOT coalesce(o_orderstatus = 'P', false)""",
    "delete_where_partitioned": """SELECT * FROM orders
        WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 200000)""",
    "update_where": """SELECT c_custkey,
        CASE WHEN c_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal
        FROM customer""",
    "add_drop_column": """SELECT p_partkey, p_brand, p_type, p_size, p_retailprice,
        p_name AS note FROM part""",
    "add_id_new": "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, * FROM orders",
    "add_id_copies": f"""SELECT row_number() OVER (ORDER BY {', '.join(_LINEITEM)}) AS id, *
        FROM lineitem""",
    "add_id_frame_order": "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey FROM orders",
    "add_id_by_file": "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, * FROM orders",
    "add_id_reserved": """SELECT n + CASE WHEN part = 2 THEN 100 ELSE 0 END AS id, o_orderkey, o_totalprice
        FROM (SELECT *, o_orderkey % 3 AS part,
                     row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey) AS n FROM orders) t""",
    "append_once": """SELECT o_orderkey, o_orderpriority,
        'batch ''' || (o_orderkey % 3) || '''' AS batch FROM orders""",
    "append_unique": """WITH lines AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
        late AS (SELECT l_orderkey, CASE WHEN l_orderkey % 100 <> 19 THEN l_linenumber END AS l_linenumber,
                        CAST(l_orderkey % 100 = 8 AS BIGINT) AS n_stored
                 FROM lines WHERE l_orderkey % 10 = 9 OR l_orderkey % 100 = 8)
        SELECT l_orderkey, l_linenumber, count(*) AS n, max(n_stored) AS n_stored,
               (SELECT count(*) FROM lines WHERE l_orderkey % 10 < 9) AS n_rows
        FROM late GROUP BY l_orderkey, l_linenumber
        HAVING l_linenumber IS NULL OR max(n_stored) > 0""",
    "max_id_footers": """WITH numbered AS (
            SELECT row_number() OVER (ORDER BY o_orderkey) AS id, * FROM orders)
        SELECT count(*) FILTER (kept) AS n, max(id) AS max_before, max(id) FILTER (kept) AS max_after
        FROM (SELECT *, NOT (id % 10 > 6 OR o_totalprice < 1000) AS kept FROM numbered) t""",
    "delete_where_files": """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
        WHERE NOT (l_orderkey BETWEEN 1000 AND 2999 AND l_quantity > 20)""",
    "update_where_files": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_orderkey >= 1500 THEN l_suppkey END AS l_suppkey,
        CASE WHEN l_orderkey < 1500 THEN -l_quantity ELSE l_quantity END AS l_quantity FROM lineitem""",
    "rewrite_in_one_step": """SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus,
        o_totalprice * 2 AS double_price FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus, NULL FROM orders WHERE o_totalprice > 300000""",
    "add_id_append": """SELECT row_number() OVER (ORDER BY
        CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END, o_orderkey) AS id, * FROM orders""",
    "add_id_position": """SELECT c_custkey, c_name,
        row_number() OVER (ORDER BY batch, c_custkey) AS id, c_nationkey
        FROM (SELECT *, 0 AS batch FROM customer
              UNION ALL SELECT *, 1 AS batch FROM customer WHERE c_acctbal < 0) t""",
    "add_id_missing_column": """SELECT *, row_number() OVER (ORDER BY
        CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END, c_custkey) AS id FROM customer""",
    "add_id_all_null": """SELECT row_number() OVER (ORDER BY
        CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END, s_suppkey) AS id, * FROM supplier""",
    "add_id_partial_null": """SELECT CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey + 1 END
        AS id, s_suppkey FROM supplier
        UNION ALL SELECT (SELECT max(s_suppkey + 1) FROM supplier WHERE s_suppkey % 7 <> 0)
        + row_number() OVER (ORDER BY s_suppkey), s_suppkey FROM supplier WHERE s_acctbal < 0""",
    "max_id": "SELECT max(o_orderkey) AS max_id FROM orders",
    "max_id_empty": "SELECT max(o_orderkey) AS max_id FROM orders WHERE o_totalprice < 0",
    "next_id": "SELECT count(*) AS n, count(*) + 1 AS next_id FROM orders",
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "clean_names": """SELECT c_custkey AS cust_key, c_name AS customer_name,
        c_acctbal AS acctbal_usd FROM customer""",
    "clean_names_collision": """SELECT l_orderkey AS a, l_partkey AS a_2, l_suppkey AS a_3
        FROM lineitem""",
    "escape_quotes": """SELECT p_partkey,
        replace(replace(concat('it''s "', p_name, '"'), '''', ''''''), '"', '''''') AS note
        FROM part""",
    "escape_quotes_html": """SELECT page_id,
        replace(replace(html, '''', ''''''), '"', '''''') AS html FROM pages""",
    "escape_quotes_nulls": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL
        ELSE replace(replace(text, '''', ''''''), '"', '''''') END AS text FROM documents""",
    "strip_unsafe": r"""SELECT event_id, replace(replace(replace(replace(
        concat('[', props, '\', ']'), '\', ''), '"', ''), '[', ''), ']', '') AS props
        FROM events""",
    "null_geometry_placeholder": """SELECT s_suppkey AS key,
        concat('POINT(', s_nationkey, ' 0)') AS geometry FROM supplier
        UNION ALL SELECT c_custkey, NULL FROM customer""",
    "load_csv": """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey, c_name,
        CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "load_csv_na": """SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
        FROM orders""",
    "load_csv_line_breaks": "SELECT doc_id, text, source FROM documents",
    "load_json_records": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "load_json_lines": "SELECT conv_id, turn, role, text FROM conversations",
    "load_json_columns": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "load_xlsx": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal
        FROM customer""",
    "pipe_csv_roundtrip": "SELECT doc_id, text FROM documents",
    "empty_to_null": """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS lang
        FROM documents""",
    "geo_point": """SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS x,
        CAST(c_custkey % 90 AS DOUBLE) AS y, 4326 AS srid FROM customer""",
    "geo_line": """SELECT l_orderkey, 3 AS n_points, CAST(l_linenumber AS DOUBLE) AS first_x,
        CAST(l_suppkey AS DOUBLE) AS last_x FROM lineitem""",
    "geo_polygon": """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END AS n_rings,
        CAST(p_size AS DOUBLE) AS second_y, true AS is_valid FROM part""",
    "geo_valid": "SELECT c_custkey, c_custkey % 3 = 0 AS is_valid FROM customer",
    "geo_add_column": """SELECT c_custkey, c_name, 'POINT' AS geom_type, 4326 AS srid
        FROM customer""",
    "geo_reject_all": f"""SELECT *,
        CASE WHEN c_custkey = 0 THEN 'POINT (1 2' ELSE {_POINT} END AS wkt,
        CAST(1 AS BIGINT) AS refused FROM customer""",
    "geo_roundtrip": """SELECT c_custkey,
        concat('POINT(', c_nationkey, ' ', c_custkey % 90, ')') AS wkt,
        CAST(c_nationkey AS DOUBLE) AS x, CAST(c_custkey % 90 AS DOUBLE) AS y FROM customer""",
    "upload_wkt_append": """SELECT
        row_number() OVER (ORDER BY c_custkey % 3 <> 0, c_custkey) AS id, c_custkey,
        CAST(c_nationkey AS DOUBLE) AS x, CAST(c_custkey % 90 AS DOUBLE) AS y FROM customer""",
    "upload_typed_geometry": """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey,
        CAST(c_nationkey AS DOUBLE) AS x, CAST(c_custkey % 90 AS DOUBLE) AS y FROM customer""",
    "delete_where_many_partitions": """SELECT * FROM (SELECT l_orderkey, l_partkey, l_linenumber,
        nullif(l_orderkey % 1601, 1600) AS part FROM lineitem) t
        WHERE NOT (coalesce(part < 1500, true) AND l_linenumber < 7)""",
    "run_statement": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
        UNION ALL SELECT -o_orderkey, 'N', o_totalprice FROM orders WHERE o_totalprice > 200000""",
    "load_csv_file_order": """SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey,
        o_orderstatus || chr(10) || o_orderpriority AS note FROM orders""",
    "load_json_file_order": """SELECT row_number() OVER (ORDER BY p_partkey) AS id, p_partkey,
        p_name FROM part""",
    "load_csv_stray_quotes": """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0
        THEN '5" ' || p_name ELSE '6"' || chr(10) || p_name END AS v FROM part""",
    "load_json_lines_auto": "SELECT conv_id, turn, role, text FROM conversations",
    "geo_ewkb": """WITH told AS (
            SELECT o_orderkey, o_orderkey % 7 = 0 AS none, o_orderkey % 11 = 0 AS damaged, o_orderkey % 6 AS kind,
                   [0.0::DOUBLE, 1.5, -2.25, 0.1, 1e10][o_orderkey % 5 + 1] AS x,
                   [0.0::DOUBLE, 1.5, -2.25, 0.1, 1e10][(o_orderkey // 5) % 5 + 1] AS y
            FROM orders)
        SELECT o_orderkey,
               CASE WHEN NOT none THEN ['POINT', 'LINESTRING', 'POLYGON', 'MULTIPOINT', 'MULTILINESTRING',
                                        'MULTIPOLYGON'][kind + 1] END AS shape,
               CASE WHEN NOT none THEN CASE WHEN kind IN (0, 2, 5) THEN 3857 ELSE 4326 END END AS srid,
               CASE WHEN NOT none AND NOT damaged THEN CASE WHEN kind < 3 THEN 1 ELSE 2 END END AS n_rings,
               CASE WHEN NOT none AND NOT damaged THEN CASE WHEN kind < 3 THEN 1 ELSE 2 END END AS n_parts,
               CASE WHEN NOT none AND NOT damaged THEN x END AS first_x,
               CASE WHEN NOT none AND NOT damaged THEN CASE WHEN kind IN (0, 2, 5) THEN y ELSE x END END AS last_y,
               none OR NOT damaged AS is_valid
        FROM told""",
}
