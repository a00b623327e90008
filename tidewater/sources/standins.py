"""ERP source tables derived from the driver's TPC-H-style test tables.

The reference reads 42 tables of a replicated ERP. The test data has none of
them, so each one is defined here as a SELECT over the given tables
(``orders``, ``lineitem``, ``part``, ``supplier``, ``customer``, ``nation``,
``region``, ``events``) with plain column expressions. Facts and masters grow
with the data (orders -> PO headers, lineitem -> PO lines, supplier ->
vendors, customer -> parties and contacts, events -> messages); code lists are
taken from ``region`` and ``nation`` and stay small.

The same text is used twice: Spark runs it (``spark.sql`` with the base tables
passed as DataFrames), and the DuckDB oracle puts it in a WITH clause. So it
keeps to SQL both engines read the same way: CASE, ``||``, integer ``%``,
division by integers, interval literals, TIMESTAMP literals, UNION ALL.

The modulus patterns plant the cases of FIXTURES.md: soft-deleted rows, NULL
flags and dates, missing lookups, repeated calendar days, two receipt
sources on one line, vendors with two subsidiaries, duplicate addresses.
Every fact and bridge table takes every row of its source table; where a
case needs a row to be missing (a PO without carrier header, a line without
receipt, a product group that no row names), the row is kept as an orphan whose
key is NULL, which never joins. No row of a given table is filtered out.

Placeholders ``{yday}`` and ``{today}`` are the inventory snapshot days
(start of yesterday and of today in the snapshot zone), made from ``as_of``.
"""

from __future__ import annotations


def _tranid(key: str) -> str:
    # PO number as text; one PO in 101 has none.
    return f"CASE WHEN {key} % 101 = 100 THEN NULL ELSE CAST({key} + 100000 AS STRING) END"


def _sku(key: str) -> str:
    return f"'SKU-' || CAST({key} AS STRING)"


def _labels(name_col: str, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(labels))
    return f"CASE {name_col} {whens} END"


def _code_list(labels: list[str], deleted: int | None = None, key: str = "r_regionkey") -> str:
    dele = f"({key} = {deleted})" if deleted is not None else "FALSE"
    return (
        f"SELECT CAST({key} AS BIGINT) AS list_id, {_labels(key, labels)} AS list_item_name, "
        f"{dele} AS _fivetran_deleted FROM region"
    )


CONTACT_BASE = 1000000000  # contact ids sit above every vendor id in address_book


STANDINS: dict[str, str] = {}

# ------------------------------------------------------------------ PO header
STANDINS["transactions"] = f"""
SELECT
  o_orderkey AS transaction_id,
  {_tranid('o_orderkey')} AS tranid,
  CASE WHEN o_orderkey % 10 = 9 THEN 'Sales Order' ELSE 'Purchase Order' END AS transaction_type,
  o_orderdate AS trandate,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 30 HOUR
       ELSE o_orderdate + INTERVAL 7 DAY END AS ship_date,
  o_orderdate + INTERVAL 60 DAY AS cancel_date,
  o_orderdate + INTERVAL 5 DAY AS original_ship_date,
  o_orderdate + INTERVAL 45 DAY AS original_cancel_date,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderdate + INTERVAL 90 DAY END AS due_date,
  o_orderdate + INTERVAL 30 DAY AS fixed_payment_date,
  CASE o_orderstatus WHEN 'O' THEN 'Pending Receipt' WHEN 'P' THEN 'Partially Received'
       ELSE 'Closed' END AS status,
  o_custkey AS entity_id,
  o_custkey % 50 AS sales_rep_id,
  o_orderkey % 6 AS po_type_id,
  o_custkey % 25 AS season_code_id,
  o_orderkey % 5 AS season_year_id,
  o_custkey % 26 AS merchandise_division_id,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 8 END AS location_id,
  CAST(o_orderkey % 8 + 100 AS STRING) AS location_code,
  o_orderkey % 5 AS currency_id,
  o_orderkey % 4 AS integration_status_id,
  o_orderkey % 3 AS ready_for_860_transmit_id,
  (o_orderkey + 1) % 3 AS purchase_order_change_statu_id,
  (o_orderkey + 2) % 6 AS acknowledgment_type_id,
  o_custkey % 3 AS allocation_channel_id,
  o_orderkey % 4 AS po_category_id,
  o_custkey % 6 AS payment_terms_id,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(3 AS DOUBLE)
       WHEN 2 THEN CAST(5 AS DOUBLE) / 2 ELSE CAST(10 AS DOUBLE) END AS days_to_edit,
  o_orderdate + INTERVAL 50 HOUR AS n_850_last_execution_timestamp,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL 75 HOUR END
    AS n_860_last_execution_timestamp,
  o_orderdate + INTERVAL 1 DAY AS acknowledgment_date,
  'NET' || CAST(o_orderkey % 4 * 15 AS STRING) AS acknowledgment_terms,
  o_orderdate + INTERVAL 20 DAY AS acknowledgment_scheduled_date,
  o_orderpriority AS acknowledgment_memo,
  CASE o_orderkey % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' ELSE NULL END AS first_transmission,
  CASE o_orderkey % 4 WHEN 0 THEN 'F' WHEN 3 THEN NULL ELSE 'T' END AS is_finalized,
  CASE o_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'T' ELSE NULL END AS transmitted_po,
  CASE WHEN o_orderkey % 2 = 0 THEN 'T' ELSE 'F' END AS sent_to_chr,
  o_totalprice / 100 AS discount_amount,
  o_totalprice / 10 AS down_payment,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 20 END AS reserved_amount,
  o_totalprice / 50 AS shipping_amount,
  o_totalprice / 25 - 100 AS amount_change,
  o_totalprice / 4 AS amount_unbilled,
  o_totalprice AS total__amount,
  o_totalprice / 2 AS total_amount_billed,
  o_totalprice / 3 AS total_principal,
  o_totalprice / 8 AS total_qv_,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE NULL END AS total_approved,
  CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice / 40 ELSE NULL END AS refunded_amount,
  'TX-' || CAST(o_orderkey AS STRING) AS transaction_extid,
  'EXT-' || CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey AS STRING) AS external_id,
  'BATCH-' || CAST(o_orderkey % 50 AS STRING) AS po_batch_name,
  o_orderpriority AS memo,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Y' ELSE 'N' END AS competing_bids,
  CASE o_orderkey % 3 WHEN 0 THEN 'Restock' WHEN 1 THEN 'New line' ELSE NULL END AS reason_for_purchase,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Original' ELSE 'Change' END AS transaction_purpose,
  (o_orderkey % 97 = 13) AS _fivetran_deleted
FROM orders
"""

# ------------------------------------------------------------------ PO lines
STANDINS["transaction_lines"] = f"""
SELECT
  l_orderkey AS transaction_id,
  CAST(l_linenumber - 1 AS BIGINT) AS transaction_line_id,
  l_partkey AS item_id,
  l_partkey % 27 AS brand_id,
  l_suppkey % 7 AS product_group_id,
  l_suppkey % 3 AS department_id,
  CAST(l_linenumber % 6 AS BIGINT) AS unit_of_measure_id,
  'VS-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_partkey AS STRING) AS vendor_sku,
  l_returnflag || l_linestatus AS memo,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_shipdate + INTERVAL 10 DAY END
    AS expected_arrival_eta_line,
  l_quantity AS item_count,
  l_quantity AS original_transmitted_qty,
  CASE WHEN l_linestatus = 'F' THEN l_quantity WHEN l_returnflag = 'R' THEN NULL
       ELSE l_quantity / 2 END AS quantity_received_in_shipment,
  CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE CAST(0 AS DOUBLE) END AS number_billed,
  CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_quantity + l_linenumber % 3 END
    AS asn_quantity_shipped,
  CASE WHEN l_linenumber = 3 AND l_orderkey % 5 = 0 THEN NULL
       WHEN l_orderkey % 11 = 0 THEN '-' || CAST(l_partkey % 40 + 1 AS STRING) || '.5%'
       ELSE CAST(l_partkey % 90 + 10 AS STRING) || '.' || CAST(l_suppkey % 10 AS STRING) || '0'
  END AS item_unit_price,
  l_extendedprice / l_quantity AS purchase_price,
  l_extendedprice * l_discount AS discount_amount,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice END AS amount,
  CASE WHEN l_orderkey % 7 = 3 THEN NULL ELSE 'ASN-' || CAST(l_orderkey AS STRING) END AS asn_record,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_shipdate END AS asn_shipment_date,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate + INTERVAL 5 DAY END
    AS asn_estimated_delivery_date,
  l_shipdate - INTERVAL 20 DAY AS line_created_date,
  l_quantity * 2 AS quantity_available,
  CAST(l_linenumber % 4 AS BIGINT) AS acknowledgment_item_status_id,
  CAST(l_linenumber % 3 AS BIGINT) AS n_2nd_acknowledgment_item_s_id,
  l_discount AS acknowledgment_rate,
  l_shipdate AS acknowledgment_scheduled_date,
  l_quantity AS acknowledgment_scheduled_quan,
  l_returnflag AS acknowledgment_memo,
  l_shipdate + INTERVAL 1 DAY AS n_2nd_acknowledgment_scheduled,
  l_quantity / 2 AS n_2nd_acknowledgment_schedul_0,
  CASE WHEN l_linestatus = 'F' THEN 'T' ELSE 'F' END AS period_closed,
  CAST(l_partkey % 20 AS STRING) AS po__rate,
  l_extendedprice AS demand_amount,
  l_extendedprice / 2 AS demand_cogs,
  l_quantity AS demand_quantity,
  l_extendedprice / 3 AS estimated_cost,
  l_extendedprice + l_tax AS full_price,
  l_tax * 100 AS shipping_amount,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_extendedprice / 4 END AS amount_custom,
  l_extendedprice / 5 AS amount_foreign,
  l_extendedprice / 6 AS amount_pending,
  l_extendedprice / 7 AS original_cogs,
  l_quantity / 3 AS quantity_allocated,
  l_quantity / 4 AS quantity_custom,
  l_quantity - l_linenumber AS quantity_difference,
  l_quantity AS quantity_on_order,
  l_discount * 10 AS rate_custom,
  (l_orderkey % 53 = 7 AND l_linenumber = 2) AS _fivetran_deleted
FROM lineitem
"""

# ------------------------------------------------------------------ receipts, inventory
STANDINS["sb_receipts"] = f"""
SELECT CASE WHEN l_returnflag = 'R' THEN {_tranid('l_orderkey')} END AS po_number,
       {_sku('l_partkey')} AS received_sku, 'WMS' AS RECORD_SOURCE,
       CAST(l_linenumber - 1 AS BIGINT) AS po_purchase_order_item_id, l_quantity / 2 AS received_quantity
FROM lineitem
UNION ALL
SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN {_tranid('l_orderkey')} END,
       {_sku('l_partkey')}, 'ERP', CAST(l_linenumber - 1 AS BIGINT), l_quantity / 4
FROM lineitem
UNION ALL
SELECT CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN {_tranid('l_orderkey')} END,
       {_sku('l_partkey')}, 'WMS', CAST(l_linenumber - 1 AS BIGINT), CAST(1 AS DOUBLE)
FROM lineitem
"""

STANDINS["sb_inventory"] = f"""
SELECT {_sku('p_partkey')} AS sku,
       CASE p_size % 3 WHEN 0 THEN TIMESTAMP '{{yday}}' WHEN 1 THEN TIMESTAMP '{{today}}'
            ELSE TIMESTAMP '{{yday}}' - INTERVAL 7 DAY END AS snapshot_day
FROM part
UNION ALL
SELECT {_sku('p_partkey')},
       CASE WHEN p_size % 6 = 0 THEN TIMESTAMP '{{yday}}' ELSE TIMESTAMP '{{today}}' END
FROM part
"""

# ------------------------------------------------------------------ carrier
STANDINS["carrier_shipping_data"] = f"""
SELECT
  o_orderkey AS carrier_shipping_data_id,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE {_tranid('o_orderkey')} END AS carrier_shipping_data_name,
  o_orderdate + INTERVAL 36 HOUR AS date_created,
  o_orderdate + INTERVAL 60 HOUR AS last_modified_date,
  CASE o_orderkey % 10 WHEN 7 THEN 'T' WHEN 8 THEN NULL ELSE 'F' END AS is_inactive,
  CASE o_orderkey % 5 WHEN 0 THEN 'CREATED' WHEN 1 THEN NULL WHEN 2 THEN 'IN TRANSIT'
       ELSE 'DELIVERED' END AS po_shipping_status
FROM orders
"""

STANDINS["carrier_shipments"] = """
SELECT
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_orderkey END AS carrier_shipping_data_id,
  'SH-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS shipment_id,
  CASE l_linenumber WHEN 1 THEN 'Delivered' WHEN 3 THEN 'Pending' WHEN 5 THEN NULL
       ELSE 'In Transit' END AS status,
  l_shipdate + INTERVAL 4 DAY AS delivery_date,
  '1Z' || CAST(l_orderkey * 10 + l_linenumber AS STRING) AS tracking_number,
  'https://track.example/' || CAST(l_orderkey AS STRING) AS carrier_tracking_link_url,
  'DOCK-' || l_returnflag AS location_0,
  l_quantity / 10 AS pallet_count,
  l_extendedprice AS declared_value,
  l_extendedprice / 50 AS shipping_cost,
  CASE WHEN l_linestatus = 'F' THEN 'INV-' || CAST(l_orderkey AS STRING) ELSE NULL END AS invoice_number,
  CASE WHEN l_linestatus = 'F' THEN 'T' ELSE 'F' END AS invoiced,
  l_shipdate + INTERVAL 30 HOUR AS last_modified_date,
  l_shipdate + INTERVAL 2 DAY AS last_updated,
  l_shipdate + INTERVAL 3 DAY AS original_delivery_eta,
  l_shipdate - INTERVAL 1 DAY AS pick_up_date
FROM lineitem
"""

# ------------------------------------------------------------------ parties
STANDINS["entity"] = """
SELECT c_custkey AS entity_id, c_name AS name, c_name || ' / ' || c_mktsegment AS full_name,
       c_custkey % 6 AS edi_856_id, (c_custkey % 29 = 3) AS _fivetran_deleted
FROM customer
"""

STANDINS["employees"] = """
SELECT c_custkey AS employee_id, 'EMP ' || c_name AS full_name,
       'emp' || CAST(c_custkey AS STRING) || '@example.com' AS email,
       (c_custkey % 23 = 4) AS _fivetran_deleted
FROM customer
"""

STANDINS["vendors"] = """
SELECT
  s_suppkey AS vendor_id,
  'V' || CAST(s_suppkey AS STRING) AS name,
  CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_name END AS companyname,
  CASE s_suppkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE NULL END AS isinactive,
  CASE s_suppkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE NULL END AS is_person,
  s_suppkey % 5 AS vendor_type_id,
  s_suppkey % 6 AS payment_terms_id,
  s_suppkey * 3 % 160 AS created_by_ven_id,
  CASE WHEN s_suppkey % 2 = 0 THEN 'EXW' ELSE 'FOB' END AS incoterm,
  'note ' || CAST(s_suppkey AS STRING) AS comments,
  'v' || CAST(s_suppkey AS STRING) || '@vendor.example' AS email,
  'pay' || CAST(s_suppkey AS STRING) || '@vendor.example' AS email_address_for_payment_not,
  CASE WHEN s_suppkey % 5 = 1 THEN NULL
       ELSE 'ap' || CAST(s_suppkey AS STRING) || '@vendor.example' END AS accounting_email,
  '555-' || CAST(1000 + s_suppkey % 9000 AS STRING) AS phone,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE '556-' || CAST(1000 + s_suppkey % 9000 AS STRING) END AS altphone,
  '557-' || CAST(1000 + s_suppkey % 9000 AS STRING) AS fax,
  'https://v' || CAST(s_suppkey AS STRING) || '.example' AS url,
  CAST(s_suppkey AS STRING) || ' Main St' AS billaddress,
  CAST(s_nationkey % 5 AS BIGINT) AS currency_id,
  CASE s_suppkey % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' ELSE NULL END AS edi,
  s_suppkey % 5 AS edi_850_id,
  (s_suppkey + 1) % 5 AS edi_860_id,
  (s_suppkey + 2) % 5 AS edi_855_id,
  (s_suppkey + 3) % 6 AS edi_856_id,
  (s_suppkey + 4) % 5 AS edi_810_id,
  s_suppkey % 7 AS edi_846_id,
  CASE s_suppkey % 3 WHEN 0 THEN TIMESTAMP '2000-06-01 08:30:00'
       WHEN 1 THEN TIMESTAMP '2001-01-15 00:00:00' ELSE NULL END AS edi_855_activation_date,
  CASE WHEN s_suppkey % 5 = 0 THEN 'F' ELSE 'T' END AS edi_capable,
  s_acctbal AS creditlimit,
  CASE s_suppkey % 2 WHEN 0 THEN TIMESTAMP '1999-12-31 23:59:59' ELSE NULL END AS vendor_credit_limit_date,
  CAST(s_nationkey % 6 AS BIGINT) AS subsidiary,
  CASE s_suppkey % 3 WHEN 0 THEN TIMESTAMP '1998-03-04 05:06:07'
       WHEN 1 THEN TIMESTAMP '1999-07-08 09:10:11' ELSE TIMESTAMP '2000-01-02 00:00:00' END AS date_created,
  s_suppkey % 4 AS finance_status_ven_id,
  s_suppkey % 5 AS operations_status_ven_id,
  s_suppkey % 60 AS accounting_clerk_id,
  'CVX-' || CAST(s_suppkey AS STRING) AS custom_vendor_externalid,
  (s_suppkey % 31 = 30) AS _fivetran_deleted
FROM supplier
"""

STANDINS["companies"] = """
SELECT s_suppkey AS company_id, s_name AS companyname FROM supplier
"""

STANDINS["vendor_subsidiary_map"] = """
SELECT CASE WHEN s_suppkey % 7 = 6 THEN NULL ELSE s_suppkey END AS vendor_id,
       CAST(s_nationkey % 5 AS BIGINT) AS subsidiary_id,
       -s_acctbal AS balance, s_acctbal / 2 AS balance_base, -s_acctbal / 3 AS unbilled_orders,
       s_acctbal / 4 AS unbilled_orders_base, s_acctbal * 2 AS credit_limit,
       (s_suppkey % 11 = 5) AS _fivetran_deleted
FROM supplier
UNION ALL
SELECT CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey END, CAST((s_nationkey + 1) % 5 AS BIGINT), s_acctbal / 5,
       s_acctbal / 6, s_acctbal / 7, -s_acctbal / 8, s_acctbal, FALSE
FROM supplier
"""

STANDINS["address_book"] = f"""
SELECT CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_suppkey END AS entity_id, 'HQ' AS name,
       CAST(s_suppkey AS STRING) || ' Main St' AS address, 'T' AS is_default_bill_address,
       'T' AS is_default_ship_address, 'F' AS is_inactive, (s_suppkey % 13 = 4) AS _fivetran_deleted
FROM supplier
UNION ALL
SELECT CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey END, 'Warehouse', CAST(s_suppkey AS STRING) || ' Dock Rd',
       'F', 'T', CASE WHEN s_suppkey % 2 = 0 THEN 'T' ELSE 'F' END, FALSE
FROM supplier
UNION ALL
SELECT CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE c_custkey + {CONTACT_BASE} END, 'Home',
       CAST(c_custkey AS STRING) || ' Elm St', 'T', 'F', 'F', FALSE
FROM customer
UNION ALL
SELECT CASE WHEN c_custkey % 5 = 0 THEN c_custkey + {CONTACT_BASE} END, 'Office',
       CAST(c_custkey AS STRING) || ' Oak Ave', 'F', 'T', 'F', FALSE
FROM customer
UNION ALL
SELECT CASE WHEN c_custkey % 7 = 0 AND c_custkey % 5 <> 4 THEN c_custkey + {CONTACT_BASE} END, 'Home',
       CAST(c_custkey AS STRING) || ' Elm St', 'T', 'F', 'F', FALSE
FROM customer
"""

STANDINS["contacts"] = f"""
SELECT
  c_custkey + {CONTACT_BASE} AS contact_id,
  c_name AS full_name,
  'Contact ' || CAST(c_custkey AS STRING) AS name,
  CASE WHEN c_custkey % 2 = 0 THEN 'Mr.' ELSE 'Ms.' END AS salutation,
  CASE WHEN c_custkey % 13 = 12 THEN NULL ELSE 'First' || CAST(c_custkey AS STRING) END AS firstname,
  c_mktsegment AS lastname,
  CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE c_custkey % (SELECT count(*) FROM supplier) END AS company_id,
  'Buyer, ' || c_mktsegment AS title,
  CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'met ' || CAST(c_custkey % 12 + 1 AS STRING) || ' times' END AS comments,
  CASE WHEN c_custkey % 4 = 0 THEN 'T' ELSE 'F' END AS is_private,
  'c' || CAST(c_custkey AS STRING) || '@mail.example' AS email,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'alt' || CAST(c_custkey AS STRING) || '@mail.example' END AS altemail,
  '600-' || CAST(c_custkey AS STRING) AS phone,
  '601-' || CAST(c_custkey AS STRING) AS officephone,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '602-' || CAST(c_custkey AS STRING) END AS mobilephone,
  CASE WHEN c_custkey % 5 = 0 THEN '603-' || CAST(c_custkey AS STRING) ELSE NULL END AS homephone,
  '604-' || CAST(c_custkey AS STRING) AS fax,
  CAST(c_custkey AS STRING) || ' Elm St' AS address,
  CAST(c_nationkey % 6 AS BIGINT) AS subsidiary,
  CASE c_custkey % 3 WHEN 0 THEN TIMESTAMP '2001-02-01 10:00:00' WHEN 1 THEN NULL
       ELSE TIMESTAMP '2000-11-20 00:00:00' END AS last_sales_activity,
  c_custkey % 50 AS supervisior_id,
  (c_custkey + 7) % 60 AS assistant_id,
  '605-' || CAST(c_custkey % 50 AS STRING) AS supervisorphone,
  CASE WHEN c_custkey % 2 = 1 THEN NULL ELSE '606-' || CAST(c_custkey % 60 AS STRING) END AS assistantphone,
  CASE WHEN c_custkey % 6 = 5 THEN 'Yes' ELSE 'No' END AS isinactive,
  (c_custkey % 19 = 7) AS _fivetran_deleted
FROM customer
"""

STANDINS["contact_types"] = f"""
SELECT CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_custkey + {CONTACT_BASE} END AS contact_id, 'Primary' AS name,
       (c_custkey % 10 = 3) AS _fivetran_deleted
FROM customer
UNION ALL
SELECT CASE WHEN c_custkey % 4 = 0 THEN c_custkey + {CONTACT_BASE} END, c_mktsegment, FALSE FROM customer
"""

STANDINS["message"] = """
SELECT
  user_id % (SELECT count(*) FROM supplier) AS company_id,
  user_id AS author_id,
  CASE WHEN event_type = 'error' THEN user_id + 100000 ELSE user_id * 7 % 150 END AS recipient_id,
  ts AS date_0,
  event_type AS subject,
  'to' || CAST(user_id AS STRING) AS to_0,
  'from' || CAST(event_id % 13 AS STRING) AS from_0,
  event_id % 5 AS message_type_id,
  props AS message,
  (event_id % 41 = 0) AS _fivetran_deleted
FROM events
"""

# ------------------------------------------------------------------ items
STANDINS["items_cv"] = f"""
SELECT p_partkey AS item_id, {_sku('p_partkey')} AS item_extid,
       CAST(p_partkey * 7 + 100000 AS STRING) AS upc_code, p_name AS salesdescription,
       CAST(p_size % 4 AS BIGINT) AS uom_id, CAST(p_size AS BIGINT) AS axis_1_option_header_id
FROM part
"""

STANDINS["uom"] = """
SELECT CAST(r_regionkey AS BIGINT) AS uom_id,
       CASE r_regionkey WHEN 0 THEN 'Each' WHEN 1 THEN 'Dozen' WHEN 2 THEN 'Case'
            WHEN 3 THEN 'Pack' ELSE 'Pallet' END AS name,
       CASE r_regionkey WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN CAST(12 AS DOUBLE) WHEN 2 THEN NULL
            WHEN 3 THEN CAST(6 AS DOUBLE) ELSE CAST(24 AS DOUBLE) END AS conversion_rate
FROM region
"""

STANDINS["brand"] = """
SELECT CAST(n_nationkey AS BIGINT) AS brand_id, 'Brand#' || CAST(n_nationkey AS STRING) AS brand_name,
       (n_nationkey = 13) AS _fivetran_deleted
FROM nation
"""

STANDINS["product_group"] = """
SELECT CAST(CASE WHEN n_nationkey < 6 THEN n_nationkey END AS BIGINT) AS product_group_id,
       'PG ' || n_name AS product_group_name, (n_nationkey = 4) AS _fivetran_deleted
FROM nation
"""

# ------------------------------------------------------------------ org dimensions
STANDINS["merchandise_division"] = """
SELECT CAST(n_nationkey AS BIGINT) AS merchandise_division_id,
       CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE 'DIV-' || CAST(n_regionkey AS STRING) END
         AS merchandise_division_name,
       CAST(n_nationkey % 4 AS BIGINT) AS assigned_to_id,
       (n_nationkey % 11 = 10) AS _fivetran_deleted
FROM nation
"""

STANDINS["locations"] = """
SELECT CAST(CASE WHEN n_nationkey < 8 THEN n_nationkey END AS BIGINT) AS location_id, 'Loc ' || n_name AS full_name,
       CAST(100 + n_nationkey AS STRING) AS location_code, (n_nationkey = 5) AS _fivetran_deleted
FROM nation
"""

STANDINS["departments"] = """
SELECT CAST(r_regionkey AS BIGINT) AS department_id, 'Dept ' || r_name AS full_name FROM region
"""

STANDINS["subsidiaries"] = """
SELECT CAST(CASE WHEN n_nationkey < 5 THEN n_nationkey END AS BIGINT) AS subsidiary_id, 'Sub ' || n_name AS name,
       CASE WHEN n_nationkey = 3 THEN 'T' ELSE 'F' END AS isinactive,
       'TAX' || CAST(n_nationkey * 1000 + 7 AS STRING) AS state_tax_number,
       (n_nationkey = 2) AS _fivetran_deleted
FROM nation
"""

STANDINS["currencies"] = """
SELECT CAST(r_regionkey AS BIGINT) AS currency_id,
       CASE r_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CAD'
            ELSE 'MXN' END AS name,
       (r_regionkey = 4) AS _fivetran_deleted
FROM region
"""

STANDINS["payment_terms"] = """
SELECT CAST(r_regionkey AS BIGINT) AS payment_terms_id,
       'Net ' || CAST(r_regionkey * 15 AS STRING) AS name
FROM region
"""

STANDINS["vendor_types"] = """
SELECT CAST(r_regionkey AS BIGINT) AS vendor_type_id, 'Type ' || r_name AS name FROM region
"""

# ------------------------------------------------------------------ calendar
STANDINS["dim_dates"] = """
SELECT DISTINCT o_orderdate AS calendar_date,
       CAST(year(o_orderdate) * 100 + weekofyear(o_orderdate) AS BIGINT) AS REALIGNED_FISCAL_WEEK_NO
FROM orders
UNION ALL
SELECT DISTINCT CASE WHEN dayofmonth(o_orderdate) = 1 THEN o_orderdate + INTERVAL 6 HOUR END,
       CAST(year(o_orderdate) * 100 + weekofyear(o_orderdate) AS BIGINT)
FROM orders
"""

# ------------------------------------------------------------------ code lists
STANDINS["season"] = """
SELECT CAST(n_nationkey AS BIGINT) AS list_id, 'Season ' || n_name AS list_item_name FROM nation
"""
STANDINS["year1"] = """
SELECT CAST(r_regionkey AS BIGINT) AS list_id, CAST(r_regionkey + 2000 AS STRING) AS list_item_name
FROM region
"""
STANDINS["po_types"] = _code_list(
    ["Non-Inventory", "Replenishment", "Drop Ship", "Pre-Pack", "Sample"], deleted=4)
STANDINS["edi_document_type_status"] = _code_list(["Yes", "No", "Yes", "No", "Yes"])
STANDINS["acknowledgment_item_statuses"] = _code_list(
    ["Accepted", "Rejected", "Backordered", "Changed", "Pending"])
STANDINS["acknowledgment_types"] = _code_list(["AC", "AD", "AK", "RD", "ZZ"])
STANDINS["integrationstatuses"] = _code_list(
    ["Ready", "Sent", "Error"], key="CASE WHEN r_regionkey < 3 THEN r_regionkey END")
STANDINS["ready_for_860_transmit"] = _code_list(["Yes", "No", "Hold", "Later", "Never"])
STANDINS["purchase_order_change_status"] = _code_list(
    ["None", "Changed", "Cancelled", "Accepted", "Rejected"])
STANDINS["allocation_channel"] = _code_list(["Retail", "Wholesale", "Online", "Outlet", "Other"])
STANDINS["po_category"] = _code_list(["Apparel", "Footwear", "Accessories", "Equipment", "Services"])
STANDINS["finance_status"] = _code_list(
    ["Approved", "Pending", "Rejected", "On Hold", "Review"], deleted=3)
STANDINS["operations_status"] = _code_list(
    ["Cleared", "Pending", "Blocked", "On Hold", "Review"], deleted=1)

# ------------------------------------------------------------------ EDI 856
_ASN_TEXT = [
    "bill_of_lading_number", "carrier_alpha_code", "carrier_equipment_number",
    "carrier_pro_number", "carrier_routing", "carrier_trans_method_code",
]
STANDINS["edi_856_asn"] = f"""
SELECT
  o_orderkey AS edi_856_asn_id,
  o_custkey AS asn_vendor_id,
  {", ".join(f"'{n[:3].upper()}' || CAST(o_orderkey % {7 + i} AS STRING) AS {n}" for i, n in enumerate(_ASN_TEXT))},
  o_orderdate + INTERVAL 26 HOUR AS date_created,
  'ASNX-' || CAST(o_orderkey AS STRING) AS edi_856_asn_extid,
  'asn_' || CAST(o_orderkey AS STRING) || '.edi' AS edi_856_asn_file,
  'ASN' || CAST(o_orderkey + 500000 AS STRING) AS edi_856_asn_name,
  CASE WHEN o_orderkey % 4 = 0 THEN 'TL' ELSE 'CN' END AS equipment_description_code,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderdate + INTERVAL 9 DAY END AS estimated_delivery_date,
  CASE WHEN o_orderkey % 2 = 0 THEN 'PP' ELSE 'CC' END AS fob_pay_code,
  CASE o_orderkey % 6 WHEN 0 THEN 'F' WHEN 2 THEN 'T' WHEN 4 THEN NULL ELSE 'F' END AS is_inactive,
  CAST(o_orderkey % 30 + 1 AS DOUBLE) AS lading_quantity,
  o_orderdate + INTERVAL 98 HOUR AS last_modified_date,
  'CTN' || CAST(o_orderkey % 3 AS STRING) AS packing_material,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '25' END AS packing_medium,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey - o_orderkey % 10 END AS parent_id,
  'Ship from ' || CAST(o_custkey AS STRING) AS ship_from_address,
  CAST(o_custkey AS STRING) || ' Mill Rd' AS ship_from_address_1,
  CASE WHEN o_custkey % 2 = 0 THEN 'Suite ' || CAST(o_custkey % 90 AS STRING) ELSE NULL END AS ship_from_address_2,
  CAST(NULL AS STRING) AS ship_from_address_3,
  CAST(NULL AS STRING) AS ship_from_address_4,
  'Vendor ' || CAST(o_custkey AS STRING) AS ship_from_address_name,
  'City' || CAST(o_custkey % 40 AS STRING) AS ship_from_city,
  'US' AS ship_from_country,
  CAST(10000 + o_custkey % 89999 AS STRING) AS ship_from_postal_code,
  'S' || CAST(o_custkey % 50 AS STRING) AS ship_from_state,
  'DC ' || CAST(o_orderkey % 4 AS STRING) AS ship_to_address,
  CAST(o_orderkey % 4 + 1 AS STRING) || ' Depot Way' AS ship_to_address_1,
  CAST(NULL AS STRING) AS ship_to_address_2,
  CAST(NULL AS STRING) AS ship_to_address_3,
  CAST(NULL AS STRING) AS ship_to_address_4,
  'Distribution ' || CAST(o_orderkey % 4 AS STRING) AS ship_to_address_name,
  'Hub' || CAST(o_orderkey % 4 AS STRING) AS ship_to_city,
  'US' AS ship_to_country,
  CAST(80000 + o_orderkey % 4 AS STRING) AS ship_to_postal_code,
  'CO' AS ship_to_state,
  o_orderdate + INTERVAL 4 DAY AS shipment_date,
  'SHP' || CAST(o_orderkey AS STRING) AS shipment_id,
  o_orderdate + INTERVAL 3 DAY AS shipment_notice_date,
  CAST(o_orderkey % 24 AS STRING) || ':00' AS shipment_notice_time,
  CASE WHEN o_orderstatus = 'F' THEN 'CL' ELSE 'OP' END AS status_code,
  o_orderkey % 7 + 1 AS total_line_item_number,
  '00' AS tset_purpose_code,
  o_custkey AS vendor_idname_id,
  o_totalprice / 30 AS weight,
  'G' AS weight_qualifier,
  'LB' AS weight_uom,
  (o_orderkey % 43 = 11) AS _fivetran_deleted
FROM orders
"""

STANDINS["edi_856_asn_line"] = f"""
SELECT
  l_orderkey * 10 + l_linenumber AS edi_856_asn_line_id,
  l_suppkey AS asn_vendor_id,
  'PKG' || CAST(l_orderkey AS STRING) AS carrier_package_id,
  l_shipdate - INTERVAL 30 HOUR AS date_created,
  l_orderkey AS edi_856_asn_id,
  'ASNL-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS edi_856_asn_line_extid,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_shipdate + INTERVAL 6 DAY END AS estimated_delivery_date,
  CASE l_linenumber % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'T' ELSE NULL END AS is_inactive,
  l_shipdate + INTERVAL 42 HOUR AS last_modified_date,
  CAST(l_linenumber AS BIGINT) AS line_number,
  l_quantity AS line_ship_quantity,
  'MPN' || CAST(l_partkey AS STRING) AS mpn,
  'EA' AS order_qty_uom,
  CASE WHEN l_linenumber = 1 THEN 'P' ELSE 'I' END AS pack_level_type,
  CAST(l_linenumber * 6 AS STRING) AS pack_value,
  l_quantity / 4 AS pack_weight,
  'LB' AS pack_weight_uom,
  'CTN25' AS packing_material,
  '25' AS packing_medium,
  l_orderkey AS parent_id,
  l_suppkey % 26 AS po_md_id,
  l_orderkey % 6 AS po_type_id,
  'Item ' || CAST(l_partkey AS STRING) AS product_description,
  l_shipdate - INTERVAL 40 DAY AS purchase_order_date,
  l_orderkey AS purchase_order_id,
  {_tranid('l_orderkey')} AS purchase_order_id_0,
  l_quantity AS quantity_ordered,
  'EA' AS ship_qty_uom,
  l_shipdate AS shipment_date,
  'SSCC' || CAST(l_orderkey * 10 + l_linenumber AS STRING) AS shipping_serial_id,
  {_sku('l_partkey')} AS sku,
  CAST(l_partkey * 7 + 100000 AS STRING) AS upc,
  'VPN' || CAST(l_partkey AS STRING) AS vendor_part_number,
  (l_orderkey % 37 = 5) AS _fivetran_deleted
FROM lineitem
"""

# Which of the driver's tables each stand-in reads.
BASES: dict[str, tuple[str, ...]] = {}
for _name, _sql in STANDINS.items():
    BASES[_name] = tuple(
        b for b in ("orders", "lineitem", "part", "supplier", "customer", "nation", "region", "events")
        if f"FROM {b}" in _sql
    )
