-- J13: live EDI 856 headers.
SELECT edi_856_asn_id, asn_vendor_id, bill_of_lading_number, carrier_alpha_code, carrier_equipment_number,
  carrier_pro_number, carrier_routing, carrier_trans_method_code,
  strftime(date_created, '%m-%d-%Y %H:%M:%S') AS date_created, edi_856_asn_extid, edi_856_asn_file,
  edi_856_asn_name, equipment_description_code, strftime(estimated_delivery_date, '%m-%d-%Y') AS estimated_delivery_date,
  fob_pay_code, CASE WHEN is_inactive = 'F' THEN false ELSE true END AS is_inactive, lading_quantity,
  strftime(last_modified_date, '%m-%d-%Y %H:%M:%S') AS last_modified_date, packing_material, packing_medium,
  parent_id, ship_from_address, ship_from_address_1, ship_from_address_2, ship_from_address_3, ship_from_address_4,
  ship_from_address_name, ship_from_city, ship_from_country, ship_from_postal_code, ship_from_state,
  ship_to_address, ship_to_address_1, ship_to_address_2, ship_to_address_3, ship_to_address_4,
  ship_to_address_name, ship_to_city, ship_to_country, ship_to_postal_code, ship_to_state,
  strftime(shipment_date, '%m-%d-%Y') AS shipment_date, shipment_id,
  strftime(shipment_notice_date, '%m-%d-%Y') AS shipment_notice_date, shipment_notice_time, status_code,
  total_line_item_number, tset_purpose_code, vendor_idname_id, weight, weight_qualifier, weight_uom
FROM edi_856_asn
WHERE _fivetran_deleted = false
