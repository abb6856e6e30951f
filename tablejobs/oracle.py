"""Independent SQL for each registered job, as DuckDB runs it on the same
Parquet tables. Column names and types are chosen to equal the Spark result
(DuckDB sums BIGINT into HUGEINT, hence the casts).

Two oracles hold for the supplied files only. ``raw_preview`` shows the first lines
of the first CSV part file: the header, then the first rows in table order. That
the first rows are the smallest keys relies on the ``customer`` file being stored in
``c_custkey`` order and small enough for one task. ``csv_infer`` expects INTEGER keys;
inference gives BIGINT once a key passes 2^31.
"""

from __future__ import annotations

_GROUP_COUNT = ("SELECT l_returnflag, l_linestatus, count(*) AS counts "
                "FROM lineitem GROUP BY ALL")

_TOTALS = ("SELECT o_orderstatus AS key, count(*) AS n FROM orders GROUP BY 1 UNION ALL "
           "SELECT o_orderpriority, count(*) FROM orders GROUP BY 1")

# Orders' columns: type as written, as stored by Parquet and ORC, as inferred from JSON and CSV.
# CSV keys are INTEGER by inference until one passes 2^31.
_ORDER_TYPES = [("o_orderkey", "bigint", "bigint", "int"), ("o_custkey", "bigint", "bigint", "int"),
                ("o_orderstatus", "string", "string", "string"), ("o_totalprice", "double", "double", "double"),
                ("o_orderdate", "timestamp_ntz", "string", "timestamp"),
                ("o_orderpriority", "string", "string", "string")]

ORACLE_SQL: dict[str, str] = {
    # aggregation
    "group_count": _GROUP_COUNT + " ORDER BY 1 NULLS FIRST, 2 NULLS FIRST",
    "group_count_one": "SELECT user_id, count(*) AS counts FROM events GROUP BY 1",
    "view_counts_coded": ("SELECT user_id, event_type, value, count(*) AS n_readings "
                          "FROM events GROUP BY ALL ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, "
                          "3 NULLS FIRST"),
    "view_counts_spec": ("SELECT user_id, event_type, count(value) AS n_readings "
                         "FROM events GROUP BY ALL"),
    "group_sum": (f"SELECT l_linestatus, CAST(sum(counts) AS BIGINT) AS total "
                  f"FROM ({_GROUP_COUNT}) GROUP BY 1"),
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "distinct_count": "SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey FROM lineitem)",
    "unit_stats": ("SELECT event_type, round(avg(value), 6) AS avg_v, min(value) AS min_v, "
                   "max(value) AS max_v FROM events GROUP BY 1"),
    "filter_post_agg": ("SELECT l_suppkey, count(*) AS counts FROM lineitem "
                        "GROUP BY 1 HAVING count(*) > 600"),
    # projections, filters, column edits
    "select_cols": "SELECT l_orderkey, l_shipdate FROM lineitem",
    "filter_eq": "SELECT * FROM lineitem WHERE l_returnflag = 'R'",
    "filter_like": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'",
    "drop_cols": ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate "
                  "FROM orders"),
    "derive_cols": ("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, "
                    "CAST(year(o_orderdate) AS INTEGER) AS y FROM orders"),
    "convert_units": ("SELECT event_id, CASE WHEN event_type = 'click' THEN (value - 32) * 5 / 9 "
                      "WHEN event_type = 'view' THEN value END AS value_c FROM events"),
    # sort, distinct, top-n, reduce
    "distinct_rows": "SELECT DISTINCT p_name FROM part",
    "top_n": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
    "first_row": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1",
    "reduce_row": ("SELECT o_totalprice, o_orderkey FROM orders "
                   "ORDER BY 1 DESC, 2 DESC LIMIT 1"),
    "fold_any": ("SELECT count(*) AS n, list_reduce(list(1 + (l_orderkey * 10 + l_linenumber) % 2147483646), "
                 "lambda a, b: a * b % 2147483647) AS product FROM lineitem"),
    # consistency
    "fd_check": ("SELECT (SELECT count(*) FROM (SELECT DISTINCT p_name FROM part)) AS n_keys, "
                 "(SELECT count(*) FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part)) "
                 "AS n_combos"),
    "fd_pass": ("SELECT (SELECT count(*) FROM (SELECT DISTINCT c_custkey FROM customer)) "
                "AS n_keys, (SELECT count(*) FROM (SELECT DISTINCT c_custkey, c_name, "
                "c_nationkey FROM customer)) AS n_combos"),
    "fd_violations": ("SELECT p_name, count(*) AS n_combos FROM "
                      "(SELECT DISTINCT p_name, p_brand, p_type FROM part) "
                      "GROUP BY 1 HAVING count(*) > 1"),
    # partitioning, reuse, staged write, per-partition function
    "seven_steps": ("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' "
                    "GROUP BY 1 HAVING count(*) > 200"),
    "repartition_rows": "SELECT * FROM orders",
    "repartition_coalesce": "SELECT * FROM orders",
    "cache_reuse": _TOTALS,
    "shuffle_reuse": _TOTALS,
    "checkpoint_reuse": _TOTALS,
    "partition_profile": "SELECT count(*) AS n_rows, count(l_shipdate) AS n_ship FROM lineitem",
    # sources
    "csv_infer": ("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, "
                  "c_acctbal, c_mktsegment FROM customer"),
    "csv_schema": "SELECT * FROM customer",
    "csv_strings": ("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
                    "CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
                    "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"),
    "csv_noheader": ("SELECT CAST(s_suppkey AS VARCHAR) AS _c0, s_name AS _c1, "
                     "CAST(s_nationkey AS VARCHAR) AS _c2, CAST(s_acctbal AS VARCHAR) AS _c3 "
                     "FROM supplier"),
    "csv_delim": "SELECT * FROM customer",
    "parquet_inferred": "SELECT * FROM orders",
    "parquet_struct": "SELECT * FROM orders",
    "parquet_ddl": ("SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS not_in_file "
                    "FROM orders"),
    "json_roundtrip": "SELECT * FROM events",
    "default_format": "SELECT * FROM supplier",
    "raw_preview": ("SELECT value FROM (SELECT 0 AS part, 0 AS pos, "
                    "'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS value "
                    "UNION ALL SELECT * FROM (SELECT 1, c_custkey, "
                    "concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) "
                    "FROM customer ORDER BY c_custkey LIMIT 19)) ORDER BY part, pos"),
    "table_scan": "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1",
    "file_inventory": ("SELECT true AS files_match, true AS sizes_match, count(*) AS n_rows "
                       "FROM orders"),
    "file_rows": ("SELECT CAST(o_orderkey % 32 AS INTEGER) AS task, count(*) AS n_rows, true AS has_size "
                  "FROM orders GROUP BY 1"),
    "json_infer": ("SELECT event_id, ts.strftime('%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, "
                   "value, props FROM events"),
    "csv_exact": ("SELECT event_id, ts, user_id, CASE WHEN event_id % 7 = 0 THEN '\\N' ELSE event_type END "
                  "AS event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS value, "
                  "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE "
                  "'  \"a\",\\N' || chr(10) || chr(13) || props || '\\ ' END AS props FROM events"),
    "schema_audit": ("SELECT col_name, data_type, parts * (SELECT count(*) FROM orders) AS n_rows, "
                     "parts = 2 AS every_file FROM (VALUES ('o_orderkey', 'bigint', 2), "
                     "('o_custkey', 'bigint', 1), ('o_custkey', 'int', 1), ('o_orderstatus', 'string', 2), "
                     "('o_totalprice', 'double', 2), ('o_orderdate', 'timestamp_ntz', 2), "
                     "('o_orderpriority', 'string', 1), ('o_note', 'string', 1)) t(col_name, data_type, parts)"),
    "types_survive": " UNION ALL ".join(
        f"SELECT '{fmt}' AS format, '{name}' AS col_name, '{written}' AS written, '{stored}' AS stored, "
        f"count(*) FILTER ({name} IS NULL) AS n_null, CAST(0 AS BIGINT) AS n_differ FROM orders"
        for name, written, json, csv in _ORDER_TYPES
        for fmt, stored in (("parquet", written), ("orc", written), ("json", json), ("csv", csv))),
    # sinks
    "sink_overwrite": "SELECT * FROM orders",
    "sink_append": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
    "sink_ignore": "SELECT * FROM orders",
    "sink_error": "SELECT * FROM supplier",
    "sink_aggregate": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
    "table_external": "SELECT * FROM customer",
    "table_drop": "SELECT * FROM customer",
    "table_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "table_managed": "SELECT * FROM supplier",
    "table_register": "SELECT * FROM supplier",
    # catalog and SQL entry
    "view_from_df": "SELECT * FROM customer",
    "view_from_sql": "SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "sql_params": "SELECT * FROM customer WHERE c_mktsegment = 'AUTOMOBILE'",
}
