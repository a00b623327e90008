-- J09: shipments of headers in use, of live orders that have a live location, a live line and a live party.
WITH ordered AS (
  SELECT DISTINCT tranid, name AS vendor
  FROM transactions AS o JOIN entity USING (entity_id)
  WHERE transaction_type = 'Purchase Order' AND NOT o._fivetran_deleted AND NOT entity._fivetran_deleted
    AND EXISTS (SELECT 1 FROM locations AS p WHERE p.location_id = o.location_id AND NOT p._fivetran_deleted)
    AND EXISTS (SELECT 1 FROM transaction_lines AS l WHERE l.transaction_id = o.transaction_id AND NOT l._fivetran_deleted)
), sent AS (
  SELECT DISTINCT
    ordered.tranid, vendor, s.shipment_id, s.pallet_count, s.declared_value, s.shipping_cost, h.is_inactive,
    s.tracking_number, s.carrier_tracking_link_url, s.location_0, h.po_shipping_status, s.status, s.invoice_number, s.invoiced,
    h.date_created, s.last_modified_date, s.last_updated, s.delivery_date, s.original_delivery_eta, s.pick_up_date
  FROM ordered
  JOIN carrier_shipping_data AS h ON h.carrier_shipping_data_name = ordered.tranid AND h.is_inactive = 'F'
  LEFT JOIN carrier_shipments AS s USING (carrier_shipping_data_id)
), size AS (SELECT tranid, vendor, count(*) AS n_shipments FROM sent GROUP BY tranid, vendor)
SELECT
  tranid AS carrier_shipping_data, tranid AS po_number, vendor, concat('Purchase Order # ', tranid) AS custom_po_number, n_shipments,
  shipment_id, pallet_count, declared_value, shipping_cost, if(is_inactive = 'T', 'Yes', 'No') AS inactive, tracking_number,
  carrier_tracking_link_url, location_0 AS location, po_shipping_status, status, invoice_number,
  if(invoiced = 'T', 'Yes', 'No') AS invoiced, strftime(date_created, '%m-%d-%Y %H:%M:%S') AS date_created,
  strftime(last_modified_date, '%m-%d-%Y %H:%M:%S') AS last_modified, strftime(last_updated, '%m-%d-%Y %H:%M:%S') AS last_updated,
  strftime(delivery_date, '%m-%d-%Y') AS delivery_date, strftime(original_delivery_eta, '%m-%d-%Y') AS original_delivery_eta,
  strftime(pick_up_date, '%m-%d-%Y') AS pick_up_date
FROM sent JOIN size USING (tranid, vendor)
