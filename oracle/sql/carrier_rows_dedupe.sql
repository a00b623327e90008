-- J03: recent carrier headers that are in use, with their shipments under way.
WITH header AS (
  SELECT * FROM carrier_shipping_data
  WHERE date_created >= TIMESTAMP '2001-02-13 12:00:00' AND po_shipping_status <> 'CREATED' AND is_inactive = 'F'
), under_way AS (SELECT * FROM carrier_shipments WHERE status <> 'Pending'),
ordered AS (
  SELECT DISTINCT tranid, (SELECT name FROM entity WHERE entity.entity_id = o.entity_id) AS vendor
  FROM transactions AS o WHERE transaction_type = 'Purchase Order'
)
SELECT DISTINCT
  tranid AS name, vendor, concat('Purchase Order # ', tranid) AS po_number, header.po_shipping_status, header.date_created,
  header.last_modified_date AS last_modified, if(header.is_inactive = 'T', 'Yes', 'No') AS inactive,
  tranid AS carrier_shipping_data, s.last_updated, s.shipment_id, s.status, s.delivery_date, s.tracking_number,
  s.carrier_tracking_link_url, s.tracking_number AS tracking_number_html, s.original_delivery_eta, s.pick_up_date,
  s.location_0 AS location, s.pallet_count, s.declared_value, s.shipping_cost, s.invoice_number,
  if(s.invoiced = 'T', 'Yes', 'No') AS invoiced
FROM under_way AS s
JOIN header USING (carrier_shipping_data_id)
JOIN ordered ON ordered.tranid = header.carrier_shipping_data_name
