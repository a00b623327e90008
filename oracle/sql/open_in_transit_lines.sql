-- J01: start from the shipped lines whose window is open, keep those of EDI
-- partners' orders, and read every label by its key.
WITH shipped AS (
  SELECT *, coalesce(CAST(asn_estimated_delivery_date AS DATE), CAST(asn_shipment_date AS DATE)) + 14 AS until
  FROM transaction_lines
  WHERE asn_record IS NOT NULL AND transaction_line_id > 0 AND asn_quantity_shipped > quantity_received_in_shipment
), partner AS (
  SELECT entity_id, name FROM entity
  WHERE edi_856_id IN (SELECT list_id FROM edi_document_type_status WHERE list_item_name = 'Yes')
), stocked AS (
  SELECT * FROM transactions
  WHERE transaction_type = 'Purchase Order'
    AND po_type_id IN (SELECT list_id FROM po_types WHERE list_item_name <> 'Non-Inventory')
)
SELECT
  partner.name AS vendor,
  (SELECT brand_name FROM brand WHERE brand.brand_id = shipped.brand_id) AS brand,
  stocked.trandate AS po_date, stocked.ship_date, stocked.cancel_date, stocked.tranid AS po_number,
  (SELECT merchandise_division_name FROM merchandise_division AS d WHERE d.merchandise_division_id = stocked.merchandise_division_id) AS merchandise_division,
  (SELECT list_item_name FROM po_types WHERE list_id = stocked.po_type_id) AS po_type,
  (SELECT list_item_name FROM season WHERE list_id = stocked.season_code_id) AS season_code,
  (SELECT list_item_name FROM year1 WHERE list_id = stocked.season_year_id) AS season_year,
  (SELECT full_name FROM employees WHERE employee_id = stocked.sales_rep_id) AS buyer,
  shipped.transaction_line_id AS line_id, items_cv.item_extid AS sku, shipped.vendor_sku, items_cv.upc_code AS upc, shipped.memo,
  shipped.expected_arrival_eta_line, shipped.item_count AS quantity_in_transaction_unit, shipped.original_transmitted_qty,
  shipped.quantity_received_in_shipment AS quantity_fulfilled_received, shipped.number_billed AS quantity_billed,
  shipped.asn_quantity_shipped - shipped.quantity_received_in_shipment AS qty_in_transit,
  (SELECT name FROM uom WHERE uom.uom_id = items_cv.uom_id) AS units, shipped.item_unit_price AS rate, shipped.discount_amount,
  shipped.purchase_price, shipped.amount, shipped.asn_record, shipped.asn_quantity_shipped, shipped.asn_shipment_date,
  shipped.asn_estimated_delivery_date, stocked.n_860_last_execution_timestamp AS n_860_sent, stocked.status,
  'Yes' AS in_transit_window, shipped.until AS transit_window_end
FROM shipped
JOIN stocked USING (transaction_id)
JOIN partner ON partner.entity_id = stocked.entity_id
LEFT JOIN items_cv ON items_cv.item_id = shipped.item_id
WHERE shipped.until >= DATE '2001-03-15'
