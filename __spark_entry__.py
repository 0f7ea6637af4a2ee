"""

``queries()`` maps each name to ``callable(spark, sf_dir) -> DataFrame``
(the Spark implementation lives in ``order_mart``); ``oracle_sql()`` gives the
same result as plain SQL over the pre-registered test tables.  Both sides
start from the same deterministic binding of the test tables to the four
order sources (``order_mart.sources.binding``), spelled out below as CTEs.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# make the package importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the canonical fact_daily_orders over sf0.001 (results do
    not depend on the session time zone; see tests/test_oracle.py)."""
    from order_mart.plans.registry import REGISTRY
    return REGISTRY["fact_daily_orders"](spark, SF_SMOKE)


def _llm() -> tuple[dict, dict]:
    """Queries and oracle SQL of the training-data subpackage, which may be
    absent together with ``corpus_pipeline.py``, or not importable here."""
    queries, oracles = {}, {}
    try:
        from order_mart.llm.queries import ORACLES, QUERIES
    except ImportError:
        return queries, oracles
    queries.update(QUERIES)
    oracles.update(ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        return queries, oracles
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from order_mart.plans.registry import REGISTRY
    return {**REGISTRY, **_llm()[0]}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB).  BINDING turns the test tables into the four sources.
# ---------------------------------------------------------------------------
BINDING = """
WITH customer_master AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS customerid,
         c.c_name AS name,
         CAST(c.c_custkey AS VARCHAR) || ' ' || c.c_mktsegment AS address,
         n.n_name AS city,
         r.r_name AS state,
         CAST(100000 + c.c_custkey % 900000 AS INTEGER) AS pincode,
         TIMESTAMP '2023-01-01 00:00:00' + to_seconds((c.c_custkey * 86399) % 31536000) AS update_timestamp
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
product_master AS (
  SELECT CAST(p_partkey AS BIGINT) AS productid,
         chr(CAST(97 + p_partkey % 26 AS INTEGER)) || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') AS productcode,
         concat_ws(' ', p_brand, p_type) AS productname,
         CAST(1 + p_size % 8 AS VARCHAR) || 'KG' AS sku,
         CAST(floor(p_retailprice) AS INTEGER) AS rate,
         p_partkey % 2 = 0 AS isactive
  FROM part
),
order_items AS (
  SELECT CAST(l_orderkey AS BIGINT) AS orderid,
         CAST(l_partkey AS BIGINT) AS productid,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem
),
order_steps AS (
  SELECT CAST(o_orderkey AS BIGINT) AS orderid,
         CAST(o_custkey AS BIGINT) AS customerid,
         o_orderstatus AS st,
         o_orderdate AS t0,
         o_orderdate + to_seconds(1 + (o_orderkey * 7919) % 86400) AS t1,
         o_orderdate + to_seconds(1 + (o_orderkey * 7919) % 86400)
                     + to_seconds(1 + (o_orderkey * 104729) % 86400) AS t2
  FROM orders
),
order_details AS (
  SELECT orderid, customerid, t0 AS order_status_update_timestamp, 'Received' AS order_status
  FROM order_steps
  UNION ALL
  SELECT orderid, customerid, t1, 'InProgress' FROM order_steps WHERE st IN ('P', 'F')
  UNION ALL
  SELECT orderid, customerid, t2, 'Delivered' FROM order_steps WHERE st = 'F'
)
"""

# Canonical status comparison: spelling-normalised.
_NORM = "lower(replace(order_status, '_', ''))"

_SECONDS = "date_diff('microsecond', {a}, {b}) / 1000000.0"

_BODIES: dict[str, str] = {
    # ------------------------------------------------------------- sources
    "scan_customer_master": "SELECT * FROM customer_master",
    "scan_product_master": "SELECT * FROM product_master",
    "scan_order_details": "SELECT * FROM order_details",
    "scan_order_items": "SELECT * FROM order_items",
    # ---------------------------------------------------- composite outputs
    "fact_daily_orders": f"""
, life AS (
  SELECT orderid, min(customerid) AS customerid,
         min(CASE WHEN {_NORM} = 'received' THEN order_status_update_timestamp END) AS order_received_timestamp,
         max(CASE WHEN {_NORM} = 'delivered' THEN order_status_update_timestamp END) AS order_delivery_timestamp
  FROM order_details
  WHERE orderid IS NOT NULL AND customerid IS NOT NULL
  GROUP BY orderid
),
totals AS (
  SELECT oi.orderid,
         sum(CAST(oi.quantity AS BIGINT) * CAST(pm.rate AS BIGINT)) AS order_amount,
         sum(CAST(oi.quantity AS BIGINT)) AS item_count
  FROM order_items oi JOIN product_master pm ON oi.productid = pm.productid
  GROUP BY oi.orderid
)
SELECT CAST(l.customerid AS BIGINT) AS customerid,
       CAST(l.orderid AS BIGINT) AS orderid,
       l.order_received_timestamp,
       l.order_delivery_timestamp,
       CAST(cm.pincode AS BIGINT) AS pincode,
       CAST(coalesce(t.order_amount, 0) AS BIGINT) AS order_amount,
       CAST(coalesce(t.item_count, 0) AS BIGINT) AS item_count,
       CAST(round({_SECONDS.format(a='l.order_received_timestamp', b='l.order_delivery_timestamp')}) AS BIGINT)
         AS order_delivery_time_seconds
FROM life l
LEFT JOIN totals t ON l.orderid = t.orderid
JOIN customer_master cm ON l.customerid = cm.customerid
WHERE l.order_received_timestamp IS NOT NULL AND l.order_delivery_timestamp IS NOT NULL
""",
    "fact_daily_orders_pipeline": f"""
, cust_orders AS (
  SELECT cm.customerid, cm.pincode, od.orderid, od.order_status_update_timestamp AS ts, od.order_status
  FROM customer_master cm LEFT JOIN order_details od ON cm.customerid = od.customerid
  WHERE od.order_status IS DISTINCT FROM 'In_progress'
),
grp AS (
  SELECT customerid, pincode, orderid,
         min(CASE WHEN order_status = 'Received' THEN ts END) AS start_ts,
         min(CASE WHEN order_status = 'Delivered' THEN ts END) AS end_ts
  FROM cust_orders
  WHERE customerid IS NOT NULL AND pincode IS NOT NULL AND orderid IS NOT NULL
  GROUP BY customerid, pincode, orderid
),
lines AS (
  SELECT DISTINCT g.customerid, g.pincode, g.orderid, g.start_ts, g.end_ts, oi.productid, oi.quantity, pm.rate
  FROM grp g
  LEFT JOIN order_items oi ON g.orderid = oi.orderid
  LEFT JOIN product_master pm ON oi.productid = pm.productid
  WHERE g.start_ts IS NOT NULL AND g.end_ts IS NOT NULL
)
SELECT CAST(customerid AS BIGINT) AS cust_id, pincode, CAST(orderid AS BIGINT) AS order_id,
       start_ts AS order_received_timestamp, end_ts AS order_delivery_timestamp,
       CAST(coalesce(sum(CAST(quantity AS BIGINT)), 0) AS BIGINT) AS item_count,
       CAST(coalesce(sum(CAST(quantity AS BIGINT) * CAST(rate AS BIGINT)), 0) AS BIGINT) AS order_amount,
       {_SECONDS.format(a='start_ts', b='end_ts')} AS order_delivery_time_sec
FROM lines
GROUP BY customerid, pincode, orderid, start_ts, end_ts
""",
    "fact_daily_orders_sql": f"""
SELECT od.customerid, od.orderid,
       min(CASE WHEN od.order_status = 'Received' THEN od.order_status_update_timestamp END) AS order_received_timestamp,
       max(CASE WHEN od.order_status = 'Delivered' THEN od.order_status_update_timestamp END) AS order_delivery_timestamp,
       cm.pincode,
       CAST(sum(CAST(oi.quantity AS BIGINT) * CAST(pm.rate AS BIGINT)) AS BIGINT) AS order_amount,
       CAST(sum(CAST(oi.quantity AS BIGINT)) AS BIGINT) AS item_count,
       CAST(round({_SECONDS.format(
           a="min(CASE WHEN od.order_status = 'Received' THEN od.order_status_update_timestamp END)",
           b="max(CASE WHEN od.order_status = 'Delivered' THEN od.order_status_update_timestamp END)")})
            AS BIGINT) AS order_delivery_time_seconds
FROM order_details od
JOIN customer_master cm ON od.customerid = cm.customerid
JOIN order_items oi ON od.orderid = oi.orderid
JOIN product_master pm ON oi.productid = pm.productid
GROUP BY od.customerid, od.orderid, cm.pincode
""",
    "f_order_details": f"""
SELECT oi.orderid, od.order_status_update_timestamp AS order_delivery_timestamp,
       oi.productid, CAST(oi.quantity AS BIGINT) AS quantity
FROM order_items oi
JOIN order_details od ON od.orderid = oi.orderid AND {_NORM.replace('order_status', 'od.order_status')} = 'delivered'
""",
    "f_order_details_pipeline": """
SELECT DISTINCT oi.orderid AS order_id, oi.productid AS product_id, oi.quantity,
       od.order_status_update_timestamp AS order_delivery_timestamp
FROM order_items oi
LEFT JOIN order_details od ON od.orderid = oi.orderid
WHERE od.order_status = 'Delivered'
""",
    "dim_order": """
SELECT DISTINCT orderid, order_status_update_timestamp, order_status FROM order_details
""",
    "dim_product": """
SELECT productid, productcode, productname, sku, CAST(rate AS BIGINT) AS rate, isactive,
       DATE '2024-01-01' AS start_date, CAST(NULL AS DATE) AS end_date
FROM product_master
""",
    "dim_product_pipeline": """
SELECT DISTINCT productid AS product_id, productcode AS product_code, productname AS product_name,
       sku, rate, isactive, DATE '2024-01-01' AS start_date, DATE '2030-12-31' AS end_date
FROM product_master
""",
    "dim_address": """
SELECT customerid AS address_id, address, city, state, CAST(pincode AS BIGINT) AS pincode
FROM customer_master
""",
    "dim_address_pipeline": """
SELECT address AS addr, city, state, pincode,
       CAST(99 + row_number() OVER (ORDER BY customerid NULLS FIRST, address NULLS FIRST, city NULLS FIRST, state NULLS FIRST, pincode NULLS FIRST) AS BIGINT) AS addr_id
FROM customer_master
""",
    "dim_customer": """
SELECT customerid, name, customerid AS address_id,
       CAST(update_timestamp AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date
FROM customer_master
""",
    "dim_customer_pipeline": """
, kept AS (
  SELECT cm.customerid, cm.name, od.order_status_update_timestamp AS ts, od.order_status
  FROM customer_master cm LEFT JOIN order_details od ON cm.customerid = od.customerid
  WHERE od.order_status IS DISTINCT FROM 'In_progress'
),
firsts AS (
  SELECT customerid, name,
         min(CASE WHEN order_status = 'Received' THEN ts END) AS start_date,
         min(CASE WHEN order_status = 'Delivered' THEN ts END) AS end_date
  FROM kept WHERE name IS NOT NULL GROUP BY customerid, name
),
addr AS (
  SELECT customerid,
         CAST(99 + row_number() OVER (ORDER BY customerid NULLS FIRST, address NULLS FIRST, city NULLS FIRST, state NULLS FIRST, pincode NULLS FIRST) AS BIGINT) AS address_id
  FROM customer_master
)
SELECT DISTINCT k.customerid AS customer_id, k.name AS customer_name, f.start_date, f.end_date,
       a.address_id AS addr_id
FROM kept k
LEFT JOIN firsts f ON k.customerid = f.customerid AND k.name = f.name
LEFT JOIN addr a ON k.customerid = a.customerid
""",
    # ---------------------------------------------------------- operators
    "scan_sources": "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count({c}) AS n_keys FROM {t}"
        for t, c in (("customer_master", "customerid"), ("product_master", "productid"),
                     ("order_details", "orderid"), ("order_items", "orderid"))),
    "scan_projected": "SELECT orderid, order_status_update_timestamp, order_status FROM order_details",
    "literal_table": """
, steps(order_status, step) AS (VALUES ('Received', 1), ('InProgress', 2), ('Delivered', 3)),
counts AS (SELECT order_status, count(*) AS n FROM order_details GROUP BY order_status)
SELECT s.order_status, s.step, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows
FROM steps s LEFT JOIN counts c ON s.order_status = c.order_status
""",
    "conform_schema": "SELECT * FROM product_master",
    "conform_timestamps": "SELECT * FROM order_details",
    "rename_columns": """
SELECT orderid AS order_id, customerid AS customer_id, order_status_update_timestamp, order_status
FROM order_details
""",
    "drop_columns": "SELECT productid, rate FROM product_master",
    "validity_columns": """
SELECT customerid, CAST(update_timestamp AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date,
       DATE '2024-01-01' AS loaded_on
FROM customer_master
""",
    "line_amount": """
SELECT oi.orderid, oi.productid, oi.quantity, pm.rate,
       CAST(oi.quantity AS BIGINT) * CAST(pm.rate AS BIGINT) AS line_amount
FROM order_items oi JOIN product_master pm ON oi.productid = pm.productid
""",
    "dense_surrogate_key": """
SELECT customerid, address, city, state, pincode,
       CAST(99 + row_number() OVER (ORDER BY customerid NULLS FIRST, address NULLS FIRST, city NULLS FIRST, state NULLS FIRST, pincode NULLS FIRST) AS BIGINT) AS address_id
FROM customer_master
""",
    "filter_delivered": "SELECT * FROM order_details WHERE order_status = 'Delivered'",
    "filter_not_in_progress": "SELECT * FROM order_details WHERE order_status IS DISTINCT FROM 'In_progress'",
    "incremental_status": """
SELECT * FROM order_details WHERE order_status_update_timestamp >= TIMESTAMP '2000-01-01 00:00:00'
""",
    "order_lifecycle": f"""
SELECT orderid, customerid,
       min(CASE WHEN {_NORM} = 'received' THEN order_status_update_timestamp END) AS order_received_timestamp,
       max(CASE WHEN {_NORM} = 'delivered' THEN order_status_update_timestamp END) AS order_delivery_timestamp
FROM order_details GROUP BY orderid, customerid
""",
    "customer_status_history": """
SELECT cm.customerid, cm.name, od.order_status_update_timestamp, od.order_status
FROM customer_master cm LEFT JOIN order_details od ON cm.customerid = od.customerid
""",
    "item_status_history": """
SELECT oi.orderid, oi.productid, oi.quantity, od.order_status_update_timestamp, od.order_status
FROM order_items oi LEFT JOIN order_details od ON oi.orderid = od.orderid
""",
    "orders_with_items": f"""
, life AS (
  SELECT orderid, min(customerid) AS customerid,
         min(CASE WHEN {_NORM} = 'received' THEN order_status_update_timestamp END) AS order_received_timestamp,
         max(CASE WHEN {_NORM} = 'delivered' THEN order_status_update_timestamp END) AS order_delivery_timestamp
  FROM order_details WHERE orderid IS NOT NULL GROUP BY orderid
)
SELECT l.orderid, l.customerid, l.order_received_timestamp, l.order_delivery_timestamp,
       oi.productid, oi.quantity, pm.rate
FROM life l
LEFT JOIN order_items oi ON l.orderid = oi.orderid
LEFT JOIN product_master pm ON oi.productid = pm.productid
""",
    "customer_first_events": """
, kept AS (
  SELECT cm.customerid, cm.name, od.order_status_update_timestamp AS ts, od.order_status
  FROM customer_master cm LEFT JOIN order_details od ON cm.customerid = od.customerid
  WHERE od.order_status IS DISTINCT FROM 'In_progress'
),
firsts AS (
  SELECT customerid, name,
         min(CASE WHEN order_status = 'Received' THEN ts END) AS first_received_timestamp,
         min(CASE WHEN order_status = 'Delivered' THEN ts END) AS first_delivered_timestamp
  FROM kept WHERE name IS NOT NULL GROUP BY customerid, name
)
SELECT DISTINCT k.customerid, k.name, f.first_received_timestamp, f.first_delivered_timestamp
FROM kept k LEFT JOIN firsts f ON k.customerid = f.customerid AND k.name = f.name
""",
    "order_item_totals": """
SELECT oi.orderid,
       CAST(sum(CAST(oi.quantity AS BIGINT) * CAST(pm.rate AS BIGINT)) AS BIGINT) AS order_amount,
       CAST(sum(CAST(oi.quantity AS BIGINT)) AS BIGINT) AS item_count
FROM order_items oi JOIN product_master pm ON oi.productid = pm.productid
GROUP BY oi.orderid
""",
    "max_keys": """
SELECT 'order_details' AS table_name, 'orderid' AS key_column, CAST(max(orderid) AS BIGINT) AS max_key FROM order_details
UNION ALL
SELECT 'customer_master', 'customerid', CAST(max(customerid) AS BIGINT) FROM customer_master
UNION ALL
SELECT 'product_master', 'productid', CAST(max(productid) AS BIGINT) FROM product_master
""",
    "profile_table": "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM customer_master"
        for c in ("customerid", "name", "address", "city", "state", "pincode", "update_timestamp")),
    "unique_order_counts": """
SELECT 'order_details' AS table_name, 'orderid' AS column_name,
       CAST(count(DISTINCT orderid) + max(CASE WHEN orderid IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unique
FROM order_details
UNION ALL
SELECT 'order_items', 'orderid',
       CAST(count(DISTINCT orderid) + max(CASE WHEN orderid IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM order_items
""",
    "distinct_rows": "SELECT DISTINCT * FROM order_items",
    "sorted_orders": "SELECT * FROM order_details ORDER BY orderid, order_status_update_timestamp, order_status",
    "preview_first_n": """
SELECT * FROM order_details
ORDER BY orderid NULLS LAST, order_status_update_timestamp NULLS LAST, order_status NULLS LAST
LIMIT 10
""",
    "status_history_union": "SELECT * FROM order_details",
    "delivery_seconds": f"""
, life AS (
  SELECT orderid,
         min(CASE WHEN {_NORM} = 'received' THEN order_status_update_timestamp END) AS r,
         max(CASE WHEN {_NORM} = 'delivered' THEN order_status_update_timestamp END) AS d
  FROM order_details GROUP BY orderid, customerid
)
SELECT orderid, {_SECONDS.format(a='r', b='d')} AS delivery_seconds,
       CAST(round({_SECONDS.format(a='r', b='d')}) AS BIGINT) AS delivery_seconds_int
FROM life WHERE r IS NOT NULL AND d IS NOT NULL
""",
    "product_labels": "SELECT productid, productname, productcode, sku FROM product_master",
    "date_spine": f"""
, per_day AS (
  SELECT CAST(order_status_update_timestamp AS DATE) AS day, count(*) AS n
  FROM order_details WHERE {_NORM} = 'received' GROUP BY 1
),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM per_day
)
SELECT s.day, CAST(coalesce(p.n, 0) AS BIGINT) AS n_orders
FROM spine s LEFT JOIN per_day p ON s.day = p.day
""",
    "check_not_null": "\n" + "\nUNION ALL\n".join(
        [f"SELECT 'customer_master' AS table_name, '{c}' AS column_name, "
         f"CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM customer_master"
         for c in ("customerid", "name", "address", "city", "state", "pincode")]
        + ["SELECT 'order_items', 'orderid', CAST(count(*) - count(orderid) AS BIGINT) FROM order_items"]
        + [f"SELECT 'order_details', '{c}', CAST(count(*) - count({c}) AS BIGINT) FROM order_details"
           for c in ("orderid", "order_status_update_timestamp", "order_status")]),
    "check_primary_key": """
SELECT 'customer_master' AS table_name, coalesce(CAST(customerid AS VARCHAR), 'NULL') AS key_value,
       CAST(count(*) AS BIGINT) AS n_rows
FROM customer_master GROUP BY customerid HAVING count(*) > 1 OR customerid IS NULL
UNION ALL
SELECT 'product_master', coalesce(CAST(productid AS VARCHAR), 'NULL'), CAST(count(*) AS BIGINT)
FROM product_master GROUP BY productid HAVING count(*) > 1 OR productid IS NULL
""",
    "check_foreign_key": """
SELECT 'order_details' AS table_name, 'customerid' AS column_name, customerid AS key_value,
       CAST(count(*) AS BIGINT) AS n_rows
FROM order_details od
WHERE customerid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer_master cm WHERE cm.customerid = od.customerid)
GROUP BY customerid
UNION ALL
SELECT 'order_items', 'productid', productid, CAST(count(*) AS BIGINT)
FROM order_items oi
WHERE productid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM product_master pm WHERE pm.productid = oi.productid)
GROUP BY productid
""",
    "check_varchar_length": "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length, "
        f"CAST(count(CASE WHEN length({c}) > {n} THEN 1 END) AS BIGINT) AS n_too_long, "
        f"CAST(coalesce(max(length({c})), 0) AS INTEGER) AS longest FROM {t}"
        for t, c, n in (("customer_master", "name", 50), ("customer_master", "address", 100),
                        ("customer_master", "city", 30), ("customer_master", "state", 30),
                        ("product_master", "productcode", 100), ("product_master", "productname", 100),
                        ("product_master", "sku", 100), ("order_details", "order_status", 20))),
    "check_status_domain": f"""
SELECT order_status, CAST(count(*) AS BIGINT) AS n_rows,
       coalesce(order_status IN ('Received', 'InProgress', 'Delivered'), false) AS in_domain,
       {_NORM} AS normalized_status
FROM order_details GROUP BY order_status
""",
    "check_order_customer": """
SELECT orderid, min(customerid) AS min_customerid, max(customerid) AS max_customerid,
       CAST(count(*) - count(customerid) AS BIGINT) AS n_null_customer
FROM order_details WHERE orderid IS NOT NULL
GROUP BY orderid
HAVING min(customerid) <> max(customerid) OR (count(*) > count(customerid) AND min(customerid) IS NOT NULL)
""",
    "order_state": f"""
, s AS (
  SELECT orderid, min(customerid) AS customerid, max(customerid) AS customerid_most, count(*) AS n_status,
         count(*) - count(customerid) AS n_no_customer,
         min(CASE WHEN customerid IS NOT NULL AND {_NORM} = 'received' THEN order_status_update_timestamp END) AS order_received_timestamp,
         max(CASE WHEN customerid IS NOT NULL AND {_NORM} = 'delivered' THEN order_status_update_timestamp END) AS order_delivery_timestamp
  FROM order_details WHERE orderid IS NOT NULL GROUP BY orderid
),
i AS (
  SELECT oi.orderid, sum(CAST(oi.quantity AS BIGINT) * CAST(pm.rate AS BIGINT)) AS order_amount,
         sum(CAST(oi.quantity AS BIGINT)) AS item_count
  FROM order_items oi JOIN product_master pm ON oi.productid = pm.productid
  WHERE oi.orderid IS NOT NULL GROUP BY oi.orderid
)
SELECT orderid, customerid, customerid_most, CAST(coalesce(n_status, 0) AS BIGINT) AS n_status,
       CAST(coalesce(n_no_customer, 0) AS BIGINT) AS n_no_customer, order_received_timestamp, order_delivery_timestamp,
       CAST(order_amount AS BIGINT) AS order_amount, CAST(item_count AS BIGINT) AS item_count
FROM s FULL JOIN i USING (orderid)
""",
    "sketch_profile": """
SELECT column_name, n_rows, n_null, true AS within_bound FROM (
  SELECT 'orderid' AS column_name, count(*) AS n_rows, count(*) - count(orderid) AS n_null FROM order_details
  UNION ALL SELECT 'customerid', count(*), count(*) - count(customerid) FROM order_details
  UNION ALL SELECT 'order_status_update_timestamp', count(*), count(*) - count(order_status_update_timestamp) FROM order_details
  UNION ALL SELECT 'order_status', count(*), count(*) - count(order_status) FROM order_details
)
""",
    "address_key_map": """
, one AS (
  SELECT customerid, row_number() OVER (ORDER BY customerid NULLS FIRST) + 99 AS address_id
  FROM (SELECT DISTINCT customerid FROM customer_master WHERE update_timestamp < TIMESTAMP '2023-07-01 00:00:00')
),
two AS (
  SELECT customerid, row_number() OVER (ORDER BY customerid NULLS FIRST) + (SELECT coalesce(max(address_id), 99) FROM one) AS address_id
  FROM (SELECT DISTINCT customerid FROM customer_master) WHERE customerid NOT IN (SELECT customerid FROM one)
)
SELECT customerid, CAST(address_id AS BIGINT) AS address_id FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
""",
    "incremental_items": """
SELECT * FROM order_items oi
WHERE oi.orderid IN (SELECT orderid FROM order_details
                     WHERE order_status_update_timestamp >= TIMESTAMP '2000-01-01 00:00:00')
""",
    "continue_keys": """
, batch AS (
  SELECT orderid, customerid, order_status_update_timestamp FROM order_details
  WHERE order_status_update_timestamp >= TIMESTAMP '2000-01-01 00:00:00' AND order_status = 'Received'
)
SELECT orderid, customerid, order_status_update_timestamp,
       CAST(coalesce((SELECT max(orderid) FROM order_details
                      WHERE order_status_update_timestamp < TIMESTAMP '2000-01-01 00:00:00'), 0)
            + row_number() OVER (ORDER BY orderid NULLS FIRST, customerid NULLS FIRST,
                                 order_status_update_timestamp NULLS FIRST) AS BIGINT) AS new_orderid
FROM batch
""",
}


# Queries whose oracle is another query's SQL (same result by definition).
_SAME_AS = {"refresh_fact": "fact_daily_orders", "refresh_fact_by_state": "fact_daily_orders",
            "apply_batches": "fact_daily_orders", "fact_from_buckets": "fact_daily_orders", "merge_order_state": "order_state",
            "refresh_lines_by_state": "f_order_details", "incremental_items_clustered": "incremental_items",
            "refresh_fact_clustered": "fact_daily_orders", "check_primary_key_by_counts": "check_primary_key",
            "check_foreign_key_by_counts": "check_foreign_key"}


# The sources with planted faults (order_mart.sources.binding.faulty_sources):
# the clean CTEs get a prefix and the faulty ones take their names.
FAULTY_BINDING = BINDING
for _table in ("customer_master", "product_master", "order_details", "order_items"):
    FAULTY_BINDING = FAULTY_BINDING.replace(f"{_table} AS (", f"clean_{_table} AS (")
FAULTY_BINDING += """
, customers AS (
  SELECT customerid, CASE WHEN customerid % 25 = 4 THEN repeat(name, 5) ELSE name END AS name, address, city, state,
         CASE WHEN customerid % 30 = 7 THEN NULL ELSE pincode END AS pincode, update_timestamp
  FROM clean_customer_master
),
customer_master AS (SELECT * FROM customers UNION ALL SELECT * FROM customers WHERE customerid % 40 = 3),
product_master AS (SELECT * FROM clean_product_master UNION ALL SELECT * FROM clean_product_master WHERE productid % 50 = 5),
order_details AS (
  SELECT orderid,
         CASE WHEN orderid % 50 = 7 THEN customerid + 1000000000
              WHEN orderid % 50 = 11 AND order_status = 'Received' THEN NULL
              WHEN orderid % 50 = 13 AND order_status = 'InProgress' THEN customerid + 1 ELSE customerid END AS customerid,
         order_status_update_timestamp,
         CASE WHEN orderid % 50 = 8 AND order_status = 'InProgress' THEN 'In_progress'
              WHEN orderid % 50 = 9 THEN NULL
              WHEN orderid % 50 = 12 THEN repeat(order_status, 3) ELSE order_status END AS order_status
  FROM clean_order_details WHERE orderid % 50 <> 21
),
order_items AS (
  SELECT orderid, CASE WHEN orderid % 50 = 14 THEN NULL WHEN orderid % 50 = 15 THEN productid + 1000000000 ELSE productid END AS productid, quantity
  FROM clean_order_items
)
"""


def oracle_sql() -> dict[str, str]:
    from order_mart.plans.registry import FAULTY
    bodies = {**_BODIES, **{name: _BODIES[same] for name, same in _SAME_AS.items()}}
    out = {name: BINDING + body for name, body in bodies.items()}
    out.update({f"{name}_faulty": FAULTY_BINDING + bodies[name] for name in FAULTY})
    return {**out, **_llm()[1]}
