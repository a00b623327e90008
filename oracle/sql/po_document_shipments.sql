-- J12: the shipments inside each document, all fields.
SELECT c.* EXCLUDE (vendor, custom_po_number, n_shipments, carrier_shipping_data) FROM ({{q:carrier_nested_flat}}) AS c
JOIN ({{q:po_header_rollup}}) AS po ON po.po_number = c.po_number
