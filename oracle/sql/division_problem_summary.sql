-- J02: count the lines shipped beyond the ordered quantity per order, give each
-- order its division, then two groupings of those orders.
WITH excess AS (
  SELECT transaction_id, count(*) AS n FROM transaction_lines
  WHERE transaction_line_id > 0 AND asn_record IS NOT NULL AND asn_quantity_shipped > item_count
    AND coalesce(CAST(asn_estimated_delivery_date AS DATE), CAST(asn_shipment_date AS DATE)) + 14 >= DATE '2001-03-15'
  GROUP BY transaction_id
), placed AS (
  SELECT n, tranid, merchandise_division_name AS division, assigned_to_id AS assignee,
         (SELECT name FROM entity WHERE entity.entity_id = o.entity_id) AS vendor
  FROM excess JOIN transactions AS o USING (transaction_id)
  LEFT JOIN merchandise_division USING (merchandise_division_id)
  WHERE transaction_type = 'Purchase Order'
    AND EXISTS (SELECT 1 FROM po_types WHERE list_id = o.po_type_id AND list_item_name <> 'Non-Inventory')
    AND EXISTS (SELECT 1 FROM entity AS p, edi_document_type_status AS s
                WHERE p.entity_id = o.entity_id AND s.list_id = p.edi_856_id AND s.list_item_name = 'Yes')
), whole AS (
  SELECT division, count(DISTINCT vendor) AS vendors, count(DISTINCT tranid) AS orders FROM placed GROUP BY division
)
SELECT placed.division AS merchandise_division, any_value(vendors) AS count_vendors, any_value(orders) AS count_orders,
       (SELECT full_name FROM employees WHERE employee_id = assignee) AS assigned_to, sum(n) AS count_problems_lines
FROM placed JOIN whole ON placed.division IS NOT DISTINCT FROM whole.division
GROUP BY placed.division, assignee
