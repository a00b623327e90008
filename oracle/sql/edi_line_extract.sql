-- J14: live EDI 856 lines with a live PO type and division.
SELECT l.edi_856_asn_line_id, l.asn_vendor_id, l.carrier_package_id,
  strftime(l.date_created, '%m-%d-%Y %H:%M:%S') AS date_created, l.edi_856_asn_id, l.edi_856_asn_line_extid,
  strftime(l.estimated_delivery_date, '%m-%d-%Y') AS estimated_delivery_date,
  CASE WHEN l.is_inactive = 'F' THEN false ELSE true END AS is_inactive,
  strftime(l.last_modified_date, '%m-%d-%Y %H:%M:%S') AS last_modified_date, l.line_number, l.line_ship_quantity,
  l.mpn, l.order_qty_uom, l.pack_level_type, l.pack_value, l.pack_weight, l.pack_weight_uom, l.packing_material,
  l.packing_medium, l.parent_id, l.po_md_id, md.merchandise_division_name, l.po_type_id, ty.list_item_name AS po_type,
  l.product_description, strftime(l.purchase_order_date, '%m-%d-%Y') AS purchase_order_date, l.purchase_order_id,
  l.purchase_order_id_0 AS po_number, l.quantity_ordered AS po_internal_id, l.ship_qty_uom,
  strftime(l.shipment_date, '%m-%d-%Y') AS shipment_date, l.shipping_serial_id, l.sku, l.upc, l.vendor_part_number
FROM edi_856_asn_line l
LEFT JOIN po_types ty ON l.po_type_id = ty.list_id
LEFT JOIN merchandise_division md ON md.merchandise_division_id = l.po_md_id
WHERE l._fivetran_deleted = false AND ty._fivetran_deleted = false AND md._fivetran_deleted = false
