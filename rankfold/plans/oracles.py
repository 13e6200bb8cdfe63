"""The same results in SQL, for an independent engine on the same tables."""

from __future__ import annotations


def _label(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) - 1 AS DOUBLE)"


def _category(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) - 1 AS INTEGER)"


_LABEL_INDEX = (
    f"SELECT l_orderkey, l_linenumber, l_returnflag, {_label('l_returnflag')} AS idx "
    "FROM lineitem"
)
_DROP = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders"
_INDEX_THEN_DROP = (
    f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, {_label('c_mktsegment')} AS idx "
    "FROM customer"
)
_ORDER_LABELS = f"""
    SELECT l_orderkey, l_linenumber, {_label('CAST(l_orderkey AS VARCHAR)')} AS idx
    FROM lineitem"""
_DOUBLE_KEY = f"SELECT c_custkey, c_acctbal, {_category('c_acctbal')} AS idx FROM customer"

ORACLES = {
    "label_index": _LABEL_INDEX,
    "label_index_counts": f"""
        SELECT idx, count(*) AS n
        FROM (SELECT {_label('event_type')} AS idx FROM events)
        GROUP BY idx""",
    "label_mapping": f"""
        SELECT c_name AS category, {_label('c_name')} AS idx
        FROM (SELECT DISTINCT c_name FROM customer)""",
    "category_mapping": f"""
        SELECT l_partkey AS category, {_category('l_partkey')} AS idx
        FROM (SELECT DISTINCT l_partkey FROM lineitem)""",
    "label_index_unseen": f"""
        WITH learned AS (
            SELECT order_label, {_label('order_label')} AS i
            FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_label FROM lineitem))
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_label,
               coalesce(learned.i, CAST(-1 AS DOUBLE)) AS idx
        FROM orders LEFT JOIN learned
          ON learned.order_label = CAST(orders.o_orderkey AS VARCHAR)""",
    "label_index_nulls": """
        SELECT doc_id, nullif(lang, 'en') AS lang_n,
               CASE WHEN lang = 'en' THEN CAST(-1 AS DOUBLE)
                    ELSE CAST(dense_rank() OVER (ORDER BY nullif(lang, 'en') NULLS LAST) - 1
                              AS DOUBLE) END AS idx
        FROM documents""",
    "label_index_high_card": f"""
        SELECT l_orderkey, l_linenumber, {_label('CAST(l_orderkey AS VARCHAR)')} AS idx
        FROM lineitem""",
    "label_index_long_text": f"SELECT doc_id, {_label('text')} AS idx FROM documents",
    "label_index_urls": f"SELECT page_id, url, {_label('url')} AS idx FROM pages",
    "label_index_replace_output": f"""
        SELECT s_suppkey, s_name, s_nationkey, {_label('s_name')} AS s_acctbal
        FROM supplier""",
    "label_index_replace_input": f"""
        SELECT conv_id, turn, {_label('role')} AS role FROM conversations""",
    "label_index_empty_fit": """
        SELECT o_orderkey, o_orderstatus, CAST(-1 AS DOUBLE) AS idx FROM orders""",
    "category_map_unseen": f"""
        WITH learned AS (
            SELECT doc_id, {_category('doc_id')} AS i
            FROM (SELECT DISTINCT doc_id FROM labels))
        SELECT documents.doc_id, documents.source, learned.i AS idx
        FROM documents LEFT JOIN learned ON learned.doc_id = documents.doc_id""",
    "category_map_text": f"SELECT p_partkey, p_brand, {_category('p_brand')} AS idx FROM part",
    "category_map_numeric_key": f"""
        SELECT p_partkey, p_size, {_category('p_size')} AS idx FROM part""",
    "category_map_double_key": _DOUBLE_KEY,
    "category_map_time_key": f"""
        SELECT l_orderkey, l_linenumber, {_category('l_shipdate')} AS idx FROM lineitem""",
    "category_map_date_key": f"""
        SELECT o_orderkey, {_category('CAST(o_orderdate AS DATE)')} AS idx FROM orders""",
    "drop_column": _DROP,
    "drop_missing_column": "SELECT * FROM customer",
    "drop_unset_column": "SELECT * FROM supplier",
    "index_then_drop": _INDEX_THEN_DROP,
    "two_indexers": f"""
        SELECT o_orderkey, {_label('o_orderstatus')} AS status_idx,
               {_label('o_orderpriority')} AS prio_idx
        FROM orders""",
    "mixed_indexers": f"""
        WITH o AS (
            SELECT *, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(12, 2)) AS price,
                   nullif(o_orderpriority, '5-LOW') AS priority
            FROM orders)
        SELECT o_orderkey, o_orderstatus, priority, o_custkey, {_label('o_orderstatus')} AS status_idx,
               {_category('o_orderstatus')} AS status_number,
               CASE WHEN priority IS NULL THEN -1 ELSE {_label('priority NULLS LAST')} END AS prio_idx,
               {_category('day')} AS day_idx, {_category('price')} AS price_idx,
               {_category('o_custkey')} AS customer_idx
        FROM o""",
    "unread_index": "SELECT l_orderkey, l_linenumber FROM lineitem",
    "indexer_then_mapper": f"""
        SELECT p_partkey, p_name, {_label('p_name')} AS name_idx,
               {_category('p_name')} AS idx
        FROM part""",
    "model_from_mapping": """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(p_size AS INTEGER) AS idx
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "label_model_from_mapping": """
        SELECT c_custkey, n_name, coalesce(CAST(n_nationkey AS DOUBLE), -1) AS idx
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "label_index_stream": f"""
        SELECT event_id, event_type, {_label('event_type')} AS idx FROM events""",
    "reload_label_model": _LABEL_INDEX,
    "reload_category_model": _DOUBLE_KEY,
    "reload_drop": _DROP,
    "reload_estimator": f"""
        SELECT l_orderkey, l_linenumber, l_linestatus, {_label('l_linestatus')} AS idx
        FROM lineitem""",
    "reload_fitted_chain": _INDEX_THEN_DROP,
    "label_index_ranked": _ORDER_LABELS,
    "label_mapping_ranked": f"""
        SELECT order_label AS category, {_label('order_label')} AS idx
        FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_label FROM lineitem)""",
    "label_index_shuffled": _ORDER_LABELS,
    "category_map_shuffled": f"""
        WITH learned AS (
            SELECT doc_id, {_category('doc_id')} AS i FROM (SELECT DISTINCT doc_id FROM labels))
        SELECT documents.doc_id AS id,
               CASE WHEN lang <> 'en' THEN documents.doc_id END AS doc_id,
               CASE WHEN lang <> 'en' THEN learned.i END AS idx
        FROM documents LEFT JOIN learned ON learned.doc_id = documents.doc_id""",
    "label_index_shuffled_hot": _LABEL_INDEX,
    "label_index_hot_text": f"SELECT doc_id, {_label('text')} AS idx FROM documents",
    "category_map_mostly_unknown": f"""
        WITH learned AS (
            SELECT s_suppkey, {_category('s_suppkey')} AS i FROM (SELECT DISTINCT s_suppkey FROM supplier))
        SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, i AS idx
        FROM lineitem LEFT JOIN learned ON s_suppkey = l_orderkey""",
    "label_index_between": f"""
        SELECT * FROM (SELECT c_custkey, c_name, {_label('c_name')} AS idx FROM customer)
        WHERE idx BETWEEN 10 AND 99""",
    "two_shuffled_indexers": f"""
        SELECT o_orderkey, {_label('CAST(o_custkey AS VARCHAR)')} AS customer_idx,
               {_label('o_orderpriority')} AS prio_idx
        FROM orders""",
    "reload_ranked_model": _ORDER_LABELS,
    "reload_versioned_chain": _ORDER_LABELS,
    "stream_shuffled": f"SELECT event_id, user_id, {_category('user_id')} AS idx FROM events",
    "reload_dealt_model": f"""
        WITH learned AS (
            SELECT k, {_label('CAST(k AS VARCHAR)')} AS i FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem))
        SELECT l_orderkey, l_linenumber,
               CASE l_orderkey % 3 WHEN 0 THEN CAST(l_orderkey AS VARCHAR)
                                   WHEN 1 THEN '?' || CAST(l_orderkey AS VARCHAR) END AS order_label,
               CASE l_orderkey % 3 WHEN 0 THEN i ELSE -1 END AS idx
        FROM lineitem JOIN learned ON k = l_orderkey""",
    "label_index_collated": f"""
        SELECT c_custkey, {_label('lower(c_mktsegment)')} AS idx, {_category('lower(c_mktsegment)')} AS number
        FROM customer""",
    "label_index_utf16": f"""
        WITH named AS (
            SELECT c_custkey, c_name, c_custkey % 4 AS kind,
                   CASE c_custkey % 4 WHEN 0 THEN 'z' WHEN 1 THEN chr(65374) WHEN 2 THEN chr(128512)
                                      ELSE chr(57344) END || c_name AS label
            FROM customer)
        SELECT c_custkey, label,
               {_label("CASE kind WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 3 END, c_name")} AS idx
        FROM named""",
    "model_from_mapping_shuffled": """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(p_size AS INTEGER) AS idx
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "category_map_decimal_key": f"""
        SELECT l_orderkey, l_linenumber,
               {_category('CAST(l_extendedprice AS DECIMAL(12, 2))')} AS idx
        FROM lineitem""",
    "category_map_array_key": f"""
        SELECT p_partkey, {_category('[p_brand, p_type]')} AS idx FROM part""",
}
