"""Supply-chain and finance inputs derived from the test tables.

Each text is plain SQL that Spark and DuckDB read alike; ``$name`` stands for a
test table. Faults are planted through column values (states, amounts, missing
vendors) and every view keeps all rows of its tables, but for ``fx_txn_before`` and
``fx_txn_after``: the rows they leave out are what changed between the two versions.
"""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "supplier", "part", "customer", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "fx_inventory": """
        SELECT user_id AS sku_id,
               concat('WH-0', CAST(user_id % 4 + 1 AS STRING)) AS warehouse_id,
               CAST(ts AS DATE) AS transaction_date,
               CAST(value AS DECIMAL(18,4)) AS quantity_on_hand,
               CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS DECIMAL(18,4)) AS quantity_received,
               CAST(CASE WHEN event_type = 'view' THEN value ELSE 0 END AS DECIMAL(18,4)) AS quantity_shipped
        FROM $events
    """,
    "fx_sku_master": """
        SELECT p_partkey AS sku_id, p_name AS sku_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(18,4)) AS unit_cost,
               p_size * 8 AS reorder_point, p_size * 4 AS safety_stock,
               CASE WHEN p_size > 25 THEN 'CASE' ELSE 'EACH' END AS unit_of_measure
        FROM $part
    """,
    "fx_warehouses": """
        SELECT DISTINCT concat('WH-0', CAST(user_id % 4 + 1 AS STRING)) AS warehouse_id,
               concat(' depot no ', CAST(user_id % 4 + 1 AS STRING), ' ') AS warehouse_name,
               CASE WHEN user_id % 4 < 2 THEN 'north east' ELSE 'SOUTH' END AS region
        FROM $events
    """,
    "fx_movements": """
        SELECT event_id AS transaction_id, user_id AS sku_id,
               concat('WH-0', CAST(user_id % 4 + 1 AS STRING)) AS warehouse_id,
               CASE event_type WHEN 'purchase' THEN 'RCPT' WHEN 'view' THEN ' ship ' WHEN 'click' THEN 'ADJ-'
                               WHEN 'signup' THEN 'ADJ+' ELSE 'misc ' END AS transaction_type,
               CASE WHEN event_type = 'error' AND value < 5 THEN NULL
                    ELSE CAST(value AS DECIMAL(18,4)) END AS quantity,
               CAST(10 + user_id % 7 AS DECIMAL(18,4)) AS unit_cost,
               ts AS transaction_date,
               props AS reference_number,
               'scanner' AS created_by,
               ts AS modified_date,
               CASE WHEN event_type = 'signup' AND value > 100 THEN 'VOIDED' ELSE 'OK' END AS transaction_status
        FROM $events
    """,
    "fx_snapshot": """
        SELECT CAST(ts AS DATE) AS snapshot_date,
               concat('WH-0', CAST(user_id % 4 + 1 AS STRING)) AS warehouse_name,
               p_type AS category, user_id AS sku_id,
               CAST(value AS DECIMAL(18,4)) AS quantity_on_hand,
               CAST(p_retailprice AS DECIMAL(18,4)) AS unit_cost,
               p_size * 8 AS reorder_point
        FROM $events JOIN $part ON user_id = p_partkey
    """,
    "fx_purchase_orders": """
        SELECT l_orderkey AS po_id, l_suppkey AS supplier_id, l_partkey AS sku_id,
               CAST(o_orderdate AS DATE) AS po_date,
               CAST(o_orderdate + INTERVAL 14 DAY AS DATE) AS promised_delivery_date,
               CASE WHEN l_linenumber = 7 THEN NULL
                    WHEN l_quantity <= 25 THEN CAST(o_orderdate + INTERVAL 10 DAY AS DATE)
                    WHEN l_quantity <= 40 THEN CAST(o_orderdate + INTERVAL 14 DAY AS DATE)
                    ELSE CAST(o_orderdate + INTERVAL 19 DAY AS DATE) END AS actual_delivery_date,
               CAST(l_quantity AS DECIMAL(18,4)) AS ordered_qty,
               CAST(l_quantity AS DECIMAL(18,4)) - CASE WHEN l_linenumber >= 6 THEN 1 ELSE 0 END AS received_qty,
               CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price_ordered,
               CAST(CAST(p_retailprice AS DECIMAL(18,4))
                    * (1 + CAST(l_tax AS DECIMAL(4,2)) - CAST(0.04 AS DECIMAL(4,2))) AS DECIMAL(18,6))
                   AS unit_price_invoiced,
               CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'RECEIVED' ELSE 'OPEN' END AS line_status
        FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey JOIN $part ON l_partkey = p_partkey
    """,
    "fx_receipts": """
        SELECT l_orderkey * 10 + l_linenumber AS grn_id, l_suppkey AS supplier_id,
               CAST(o_orderdate AS DATE) AS receipt_date,
               CAST(l_quantity AS DECIMAL(18,4)) AS received_qty,
               CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 THEN 1 ELSE 0 END AS rejected_qty,
               CAST(l_quantity AS DECIMAL(18,4))
                   - CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 THEN 1 ELSE 0 END AS accepted_qty
        FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey
    """,
    "fx_suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
               concat('TIER-', CAST(s_suppkey % 3 + 1 AS STRING)) AS supplier_tier,
               n_name AS country_of_origin
        FROM $supplier JOIN $nation ON s_nationkey = n_nationkey
    """,
    "fx_ap_invoices": """
        SELECT l_orderkey AS invoice_number,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN NULL
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN -1
                    ELSE o_custkey END AS vendor_id,
               l_orderkey AS po_number,
               CAST(o_orderdate AS DATE) AS invoice_date,
               CASE WHEN l_linenumber = 7 THEN CAST(o_orderdate + INTERVAL 45 DAY AS DATE)
                    ELSE CAST(o_orderdate + INTERVAL 30 DAY AS DATE) END AS due_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS tax_amount,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'VOIDED'
                    WHEN l_returnflag = 'N' THEN 'PENDING' ELSE 'POSTED' END AS posting_status
        FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey
    """,
    "fx_gl_invoices": """
        SELECT invoice_number, vendor_id, po_number, gl_posting_date, payment_due_date,
               net_amount, tax_amount, net_amount + tax_amount AS gross_amount, approval_status, payment_status
        FROM (
            SELECT l_orderkey AS invoice_number,
                   CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN NULL
                        WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN -1
                        ELSE o_custkey END AS vendor_id,
                   l_orderkey AS po_number,
                   CAST(o_orderdate AS DATE) AS gl_posting_date,
                   CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS payment_due_date,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                        + CASE WHEN l_orderkey % 13 = 0 THEN 0.50 WHEN l_orderkey % 29 = 0 THEN 5000
                               WHEN l_orderkey % 31 = 0 THEN 20000 WHEN l_orderkey % 23 = 0 THEN -1
                               ELSE 0 END AS DECIMAL(18,4)) AS net_amount,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
                        + CASE WHEN l_orderkey % 23 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,4)) AS tax_amount,
                   CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'REJECTED'
                        WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'CANCELLED'
                        ELSE 'APPROVED' END AS approval_status,
                   CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'OPEN' ELSE 'PARTIAL' END AS payment_status
            FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey
            UNION ALL
            SELECT o_orderkey, o_custkey, o_orderkey, CAST(o_orderdate AS DATE),
                   CAST(o_orderdate + INTERVAL 30 DAY AS DATE),
                   CAST(0 AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4)),
                   CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 'APPROVED' ELSE 'REJECTED' END,
                   'OPEN'
            FROM $orders
        ) AS gl
    """,
    "fx_vendors": """
        SELECT c_custkey AS vendor_id, c_name AS vendor_name, c_mktsegment AS vendor_category,
               'NET30' AS payment_terms,
               concat('ap', CAST(c_custkey AS STRING), '@vendor.example') AS contact_email
        FROM $customer
    """,
    "fx_order_lines": """
        SELECT l_orderkey AS order_id,
               concat('[{"sku_id":"', CAST(l_partkey AS STRING), '","quantity":',
                      CAST(CAST(l_quantity AS INT) AS STRING), ',"unit_price":',
                      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '},{"sku_id":"',
                      CAST(l_suppkey AS STRING), '","quantity":', CAST(l_linenumber AS STRING), '}]') AS line_items_json
        FROM $lineitem
    """,
    "fx_order_documents": """
        SELECT order_id, l_linenumber,
               CASE l_linenumber WHEN 1 THEN concat('{"first":', one, ',"second":', two, '}') WHEN 2 THEN concat('[', one)
                    WHEN 3 THEN '[]' WHEN 4 THEN NULL ELSE concat('[', one, ',', two, ']') END AS line_items_json
        FROM (
            SELECT l_orderkey AS order_id, l_linenumber,
                   concat('{"sku_id":"', CAST(l_partkey AS STRING), '","quantity":',
                          CAST(CAST(l_quantity AS INT) AS STRING), '}') AS one,
                   concat('{"sku_id":', CAST(l_suppkey AS STRING), ',"unit_price":2.5}') AS two
            FROM $lineitem
        ) AS parts
    """,
    "fx_txn_before": """
        SELECT event_id AS transaction_id, user_id AS sku_id,
               concat('WH-0', CAST(user_id % 4 + 1 AS STRING)) AS warehouse_id,
               CAST(value AS DECIMAL(18,4)) AS quantity,
               CAST(10 + user_id % 7 AS DECIMAL(18,4)) AS unit_cost,
               ts AS transaction_date
        FROM $events
        WHERE ts < TIMESTAMP '2024-01-25 00:00:00'
    """,
    "fx_txn_after": """
        SELECT event_id AS transaction_id, user_id AS sku_id,
               concat('WH-0', CAST(user_id % 4 + 1 AS STRING)) AS warehouse_id,
               CAST(CAST(value AS DECIMAL(18,4)) + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END
                    AS DECIMAL(18,4)) AS quantity,
               CAST(10 + user_id % 7 AS DECIMAL(18,4)) AS unit_cost,
               ts AS transaction_date
        FROM $events
        WHERE event_type <> 'error'
    """,
    "fx_commit_log": """
        SELECT user_id AS sku_id, event_type AS channel, CAST(value AS DECIMAL(18,4)) AS quantity,
               ts AS commit_ts, event_id AS commit_id,
               CASE WHEN value < 10 THEN 'DELETE' ELSE 'UPDATE' END AS action
        FROM $events
    """,
}


def view(spark: SparkSession, sf_dir: str, name: str, **replaced: str) -> DataFrame:
    """One input over the Parquet files of ``sf_dir``; ``replaced`` names temp views to read instead."""
    files = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    return spark.sql(Template(VIEWS[name]).substitute(files | replaced))


def view_sql(name: str) -> str:
    """The same input as SQL over tables that are already registered under their names."""
    return re.sub(r"\s+", " ", Template(VIEWS[name]).substitute({t: t for t in TABLES})).strip()


def with_views(names: list[str], query: str) -> str:
    """``query`` with the named inputs in front as common table expressions."""
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n)})" for n in names) + " " + query
