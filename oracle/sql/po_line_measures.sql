-- J08 lines: one row per line group (the array elements).
SELECT po_number, item_extid, vendor_sku, item_description, po_item_description, expected_arrival_eta_line, closed, item_count, original_transmitted_qty, quantity_received_in_shipment, number_billed, unit_of_measure, conversion_rate, item_unit_price, rate, purchase_price, discount_amount, amount, product_group_name, upc_code, brand_name, options, line_created_date, quantity_available, acknowledgment_item_status, transaction_line_id, inventory_owned_flag, transaction_expected_arrival_date, acknowledgment_rate, acknowledgment_scheduled_date, acknowledgment_scheduled_quantity, acknowledgment_memo, n_2nd_acknowledgment_item_status, n_2nd_acknowledgment_scheduled_date, n_2nd_acknowledgment_schedul_quantity, asn_record, asn_quantity_shipped, asn_shipment_date, asn_estimated_delivery_date, demand_amount, demand_cogs, demand_quantity, estimated_cost, full_price, shipping_amount, amount_custom, amount_foreign, amount_pending, original_cogs, po__rate, quantity_allocated, quantity_custom, quantity_difference, quantity_on_order, rate_custom, quantity_in_transaction_unit, in_transit_window, transit_window_end, qty_in_transit, on_order_quantity, on_order_cost
FROM (
{{q:po_line_groups}}
) g
