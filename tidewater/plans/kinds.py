"""Output columns and value kinds of the registered queries (generated by
tools/gen_kinds.py; s text, i integer, d double, b boolean, t timestamp, D date)."""

KINDS = {'carrier_nested_flat': [('carrier_shipping_data', 's'), ('po_number', 's'), ('vendor', 's'),
                         ('custom_po_number', 's'), ('n_shipments', 'i'), ('shipment_id', 's'),
                         ('pallet_count', 'd'), ('declared_value', 'd'), ('shipping_cost', 'd'),
                         ('inactive', 's'), ('tracking_number', 's'), ('carrier_tracking_link_url', 's'),
                         ('location', 's'), ('po_shipping_status', 's'), ('status', 's'),
                         ('invoice_number', 's'), ('invoiced', 's'), ('date_created', 's'),
                         ('last_modified', 's'), ('last_updated', 's'), ('delivery_date', 's'),
                         ('original_delivery_eta', 's'), ('pick_up_date', 's')],
 'carrier_rows_dedupe': [('name', 's'), ('vendor', 's'), ('po_number', 's'), ('po_shipping_status', 's'),
                         ('date_created', 't'), ('last_modified', 't'), ('inactive', 's'),
                         ('carrier_shipping_data', 's'), ('last_updated', 't'), ('shipment_id', 's'),
                         ('status', 's'), ('delivery_date', 't'), ('tracking_number', 's'),
                         ('carrier_tracking_link_url', 's'), ('tracking_number_html', 's'),
                         ('original_delivery_eta', 't'), ('pick_up_date', 't'), ('location', 's'),
                         ('pallet_count', 'd'), ('declared_value', 'd'), ('shipping_cost', 'd'),
                         ('invoice_number', 's'), ('invoiced', 's')],
 'carrier_rows_in_order': [('po_number', 's'), ('vendor', 's'), ('shipment_id', 's'), ('place', 'i')],
 'catalog_lines': [('edi_856_asn_line_id', 'i'), ('asn_vendor_id', 'i'), ('carrier_package_id', 's'),
                   ('date_created', 's'), ('edi_856_asn_id', 'i'), ('edi_856_asn_line_extid', 's'),
                   ('estimated_delivery_date', 's'), ('is_inactive', 'b'), ('last_modified_date', 's'),
                   ('line_number', 'i'), ('line_ship_quantity', 'd'), ('mpn', 's'), ('order_qty_uom', 's'),
                   ('pack_level_type', 's'), ('pack_value', 's'), ('pack_weight', 'd'),
                   ('pack_weight_uom', 's'), ('packing_material', 's'), ('packing_medium', 's'),
                   ('parent_id', 'i'), ('po_md_id', 'i'), ('merchandise_division_name', 's'),
                   ('po_type_id', 'i'), ('po_type', 's'), ('product_description', 's'),
                   ('purchase_order_date', 's'), ('purchase_order_id', 'i'), ('po_number', 's'),
                   ('po_internal_id', 'd'), ('ship_qty_uom', 's'), ('shipment_date', 's'),
                   ('shipping_serial_id', 's'), ('sku', 's'), ('upc', 's'), ('vendor_part_number', 's'),
                   ('name_parts', 'i')],
 'contact_categories': [('contact_id', 'i'), ('full_name', 's'), ('contact', 's'), ('salutation_MR_MS', 's'),
                        ('name', 's'), ('company_id', 'i'), ('company', 's'), ('job_title', 's'),
                        ('comments', 's'), ('private', 's'), ('category', 's'), ('email', 's'),
                        ('altemail', 's'), ('mainphone', 's'), ('officephone', 's'), ('mobilephone', 's'),
                        ('homephone', 's'), ('fax', 's'), ('address', 's'), ('subsidiary_id', 'i'),
                        ('subsidiary', 's'), ('last_sales_activity', 't'), ('supervisor', 's'),
                        ('supervisorphone', 's'), ('assistand', 's'), ('assistantphone', 's'),
                        ('is_default_ship_address', 's'), ('is_default_bill_address', 's'), ('address1', 's'),
                        ('isinactive', 's'), ('n_category', 'i')],
 'contact_categories_active': [('contact_id', 'i'), ('full_name', 's'), ('contact', 's'),
                               ('salutation_MR_MS', 's'), ('name', 's'), ('company_id', 'i'),
                               ('company_name', 's'), ('job_title', 's'), ('comments', 's'), ('private', 's'),
                               ('category', 's'), ('email', 's'), ('altemail', 's'), ('mainphone', 's'),
                               ('officephone', 's'), ('mobilephone', 's'), ('homephone', 's'), ('fax', 's'),
                               ('address', 's'), ('subsidiary_id', 'i'), ('subsidiary', 's'),
                               ('last_sales_activity', 't'), ('supervisor', 's'), ('supervisorphone', 's'),
                               ('assistand', 's'), ('assistantphone', 's'), ('is_default_ship_address', 's'),
                               ('is_default_bill_address', 's'), ('address_tab', 's'), ('isinactive', 's'),
                               ('n_category', 'i')],
 'currency_fanout_dedupe': [('tranid', 's'), ('original_ship_date', 'D'), ('original_cancel_date', 'D'),
                            ('Carrier_Shipping_Data', 's'), ('sent_to_chr', 's'),
                            ('n_860_last_execution_timestamp', 's'), ('location_code', 'i'),
                            ('integration_status_id', 's'), ('ready_for_860_transmit_id', 's'),
                            ('n_850_last_execution_timestamp', 's'), ('acknowledgment_date', 's'),
                            ('acknowledgment_terms', 's'), ('acknowledgment_scheduled_date', 't'),
                            ('acknowledgment_memo', 's'), ('acknowledgment_type_id', 's'),
                            ('acknowledgment_item_status', 's'), ('acknowledgment_rate', 'd'),
                            ('acknowledgment_scheduled_date1', 't'), ('acknowledgment_scheduled_quan', 'd'),
                            ('acknowledgment_memo1', 's'), ('n2nd_Acknowledgment_Item_Status', 'i'),
                            ('n_2nd_acknowledgment_scheduled_date', 't'),
                            ('n_2nd_acknowledgment_scheduled_quantity', 'd'), ('asn_record', 's'),
                            ('asn_quantity_shipped', 'd'), ('asn_shipment_date', 't'),
                            ('asn_estimated_delivery_date', 't'), ('edi', 's'), ('edi_810', 's'),
                            ('edi_846', 's'), ('edi_850', 's'), ('edi_855', 's'),
                            ('edi_855_activation_date', 's'), ('edi_856', 's'), ('edi_860', 's'),
                            ('edi_capable', 's')],
 'division_problem_summary': [('merchandise_division', 's'), ('count_vendors', 'i'), ('count_orders', 'i'),
                              ('assigned_to', 's'), ('count_problems_lines', 'i')],
 'edi_header_extract': [('edi_856_asn_id', 'i'), ('asn_vendor_id', 'i'), ('bill_of_lading_number', 's'),
                        ('carrier_alpha_code', 's'), ('carrier_equipment_number', 's'),
                        ('carrier_pro_number', 's'), ('carrier_routing', 's'),
                        ('carrier_trans_method_code', 's'), ('date_created', 's'), ('edi_856_asn_extid', 's'),
                        ('edi_856_asn_file', 's'), ('edi_856_asn_name', 's'),
                        ('equipment_description_code', 's'), ('estimated_delivery_date', 's'),
                        ('fob_pay_code', 's'), ('is_inactive', 'b'), ('lading_quantity', 'd'),
                        ('last_modified_date', 's'), ('packing_material', 's'), ('packing_medium', 's'),
                        ('parent_id', 'i'), ('ship_from_address', 's'), ('ship_from_address_1', 's'),
                        ('ship_from_address_2', 's'), ('ship_from_address_3', 's'),
                        ('ship_from_address_4', 's'), ('ship_from_address_name', 's'),
                        ('ship_from_city', 's'), ('ship_from_country', 's'), ('ship_from_postal_code', 's'),
                        ('ship_from_state', 's'), ('ship_to_address', 's'), ('ship_to_address_1', 's'),
                        ('ship_to_address_2', 's'), ('ship_to_address_3', 's'), ('ship_to_address_4', 's'),
                        ('ship_to_address_name', 's'), ('ship_to_city', 's'), ('ship_to_country', 's'),
                        ('ship_to_postal_code', 's'), ('ship_to_state', 's'), ('shipment_date', 's'),
                        ('shipment_id', 's'), ('shipment_notice_date', 's'), ('shipment_notice_time', 's'),
                        ('status_code', 's'), ('total_line_item_number', 'i'), ('tset_purpose_code', 's'),
                        ('vendor_idname_id', 'i'), ('weight', 'd'), ('weight_qualifier', 's'),
                        ('weight_uom', 's')],
 'edi_line_extract': [('edi_856_asn_line_id', 'i'), ('asn_vendor_id', 'i'), ('carrier_package_id', 's'),
                      ('date_created', 's'), ('edi_856_asn_id', 'i'), ('edi_856_asn_line_extid', 's'),
                      ('estimated_delivery_date', 's'), ('is_inactive', 'b'), ('last_modified_date', 's'),
                      ('line_number', 'i'), ('line_ship_quantity', 'd'), ('mpn', 's'), ('order_qty_uom', 's'),
                      ('pack_level_type', 's'), ('pack_value', 's'), ('pack_weight', 'd'),
                      ('pack_weight_uom', 's'), ('packing_material', 's'), ('packing_medium', 's'),
                      ('parent_id', 'i'), ('po_md_id', 'i'), ('merchandise_division_name', 's'),
                      ('po_type_id', 'i'), ('po_type', 's'), ('product_description', 's'),
                      ('purchase_order_date', 's'), ('purchase_order_id', 'i'), ('po_number', 's'),
                      ('po_internal_id', 'd'), ('ship_qty_uom', 's'), ('shipment_date', 's'),
                      ('shipping_serial_id', 's'), ('sku', 's'), ('upc', 's'), ('vendor_part_number', 's')],
 'open_in_transit_lines': [('vendor', 's'), ('brand', 's'), ('po_date', 't'), ('ship_date', 't'),
                           ('cancel_date', 't'), ('po_number', 's'), ('merchandise_division', 's'),
                           ('po_type', 's'), ('season_code', 's'), ('season_year', 's'), ('buyer', 's'),
                           ('line_id', 'i'), ('sku', 's'), ('vendor_sku', 's'), ('upc', 's'), ('memo', 's'),
                           ('expected_arrival_eta_line', 't'), ('quantity_in_transaction_unit', 'd'),
                           ('original_transmitted_qty', 'd'), ('quantity_fulfilled_received', 'd'),
                           ('quantity_billed', 'd'), ('qty_in_transit', 'd'), ('units', 's'), ('rate', 's'),
                           ('discount_amount', 'd'), ('purchase_price', 'd'), ('amount', 'd'),
                           ('asn_record', 's'), ('asn_quantity_shipped', 'd'), ('asn_shipment_date', 't'),
                           ('asn_estimated_delivery_date', 't'), ('n_860_sent', 't'), ('status', 's'),
                           ('in_transit_window', 's'), ('transit_window_end', 'D')],
 'open_lines_in_order': [('po_number', 's'), ('line_id', 'i'), ('place', 'i')],
 'po_document_fields': [('expected_arrival_date', 'D'), ('po_number', 's'), ('po_title', 's'),
                        ('po_type', 's'), ('transaction_extid', 's'), ('external_id', 's'), ('memo', 's'),
                        ('buyer_name', 's'), ('po_status', 's'), ('po_terms', 's'), ('down_payment', 'd'),
                        ('po_email_sent', 's'), ('po_is_finalized', 's'), ('po_allocation_channel', 's'),
                        ('merchandise_division', 's'), ('location_code', 's'), ('integration_status', 's'),
                        ('po_first_transmission', 's'), ('ready_for_860_transmit', 's'),
                        ('record_source_system', 's'), ('po_category', 's'), ('location', 's'),
                        ('po_batch_name', 's'), ('purchase_order_change_status', 's'),
                        ('reason_for_purchase', 's'), ('competing_bids', 's'), ('cost_center', 's'),
                        ('transmitted_po', 's'), ('sent_to_chr', 's'), ('po_created_date', 's'),
                        ('po_date', 's'), ('po_cancel_date', 's'), ('po_ship_date', 's'),
                        ('po_original_ship_date', 's'), ('po_original_cancel_date', 's'),
                        ('po_due_date', 't'), ('po_fixed_payment_date', 's'), ('po_edit_date', 's'),
                        ('days_to_edit', 'd'), ('po_edit_fiscal_week_number', 'i'),
                        ('n_860_last_execution_timestamp', 's'), ('n_850_last_execution_timestamp', 's'),
                        ('days_past_due', 'i'), ('transaction_purpose', 's'), ('po_vendor_id', 'i'),
                        ('po_vendor', 's'), ('season_code', 's'), ('season_year', 's'),
                        ('acknowledgment_date', 's'), ('acknowledgment_terms', 's'),
                        ('acknowledgment_scheduled_date', 's'), ('acknowledgment_memo', 's'),
                        ('acknowledgment_type', 's'), ('line_count', 'i'), ('total_quantity', 'd'),
                        ('remaining_open_quantity', 'd'), ('received_amount', 'd'), ('discount_amount', 'd'),
                        ('reserved_amount', 'd'), ('shipping_amount', 'd'), ('amount_change', 'd'),
                        ('amount_unbilled', 'd'), ('refunded_amount', 'd'), ('total_on_order_cost', 'd'),
                        ('total_on_order_quantity', 'd'), ('ni_submitted_total', 'd'),
                        ('total_amount_lines', 'd'), ('total_amount_billed', 'd'), ('total_principal', 'd'),
                        ('total_qv_', 'd'), ('total_approved', 'd'), ('carrier_shipping_data', 's'),
                        ('created_date', 't')],
 'po_document_flat': [('expected_arrival_date', 'D'), ('po_number', 's'), ('po_title', 's'), ('po_type', 's'),
                      ('buyer_name', 's'), ('po_status', 's'), ('cost_center', 's'), ('location', 's'),
                      ('location_code', 's'), ('sent_to_chr', 's'), ('po_first_transmission', 's'),
                      ('po_edit_date', 's'), ('po_edit_fiscal_week_number', 'i'), ('days_past_due', 'i'),
                      ('po_original_ship_date', 's'), ('po_original_cancel_date', 's'), ('po_vendor', 's'),
                      ('season_code', 's'), ('acknowledgment_type', 's'), ('line_count', 'i'),
                      ('total_quantity', 'd'), ('remaining_open_quantity', 'd'), ('received_amount', 'd'),
                      ('n_lines', 'i'), ('total_on_order_cost', 'd'), ('total_on_order_quantity', 'd'),
                      ('ni_submitted_total', 'd'), ('total_amount_lines', 'd'), ('total_amount_billed', 'd'),
                      ('total_principal', 'd'), ('total_qv_', 'd'), ('total_approved', 'd'),
                      ('carrier_shipping_data', 's'), ('n_shipments', 'i'), ('updated_date', 't')],
 'po_document_lines': [('po_number', 's'), ('item_extid', 's'), ('vendor_sku', 's'),
                       ('item_description', 's'), ('po_item_description', 's'),
                       ('expected_arrival_eta_line', 'D'), ('closed', 's'), ('item_count', 'd'),
                       ('original_transmitted_qty', 'd'), ('quantity_received_in_shipment', 'd'),
                       ('number_billed', 'd'), ('unit_of_measure', 's'), ('conversion_rate', 'd'),
                       ('item_unit_price', 's'), ('rate', 's'), ('purchase_price', 'd'),
                       ('discount_amount', 'd'), ('amount', 'd'), ('product_group_name', 's'),
                       ('upc_code', 's'), ('brand_name', 's'), ('options', 'i'), ('line_created_date', 't'),
                       ('quantity_available', 'd'), ('acknowledgment_item_status', 's'),
                       ('transaction_line_id', 'i'), ('inventory_owned_flag', 'b'),
                       ('transaction_expected_arrival_date', 't'), ('acknowledgment_rate', 'd'),
                       ('acknowledgment_scheduled_date', 's'), ('acknowledgment_scheduled_quantity', 'd'),
                       ('acknowledgment_memo', 's'), ('n_2nd_acknowledgment_item_status', 's'),
                       ('n_2nd_acknowledgment_scheduled_date', 't'),
                       ('n_2nd_acknowledgment_schedul_quantity', 'd'), ('asn_record', 's'),
                       ('asn_quantity_shipped', 'd'), ('asn_shipment_date', 's'),
                       ('asn_estimated_delivery_date', 's'), ('demand_amount', 'd'), ('demand_cogs', 'd'),
                       ('demand_quantity', 'd'), ('estimated_cost', 'd'), ('full_price', 'd'),
                       ('shipping_amount', 'd'), ('amount_custom', 'd'), ('amount_foreign', 'd'),
                       ('amount_pending', 'd'), ('original_cogs', 'd'), ('po__rate', 's'),
                       ('quantity_allocated', 'd'), ('quantity_custom', 'd'), ('quantity_difference', 'd'),
                       ('quantity_on_order', 'd'), ('rate_custom', 'd'),
                       ('quantity_in_transaction_unit', 'd'), ('in_transit_window', 's'),
                       ('transit_window_end', 's'), ('qty_in_transit', 'd'), ('on_order_quantity', 'd'),
                       ('on_order_cost', 'd')],
 'po_document_shipments': [('po_number', 's'), ('shipment_id', 's'), ('pallet_count', 'd'),
                           ('declared_value', 'd'), ('shipping_cost', 'd'), ('inactive', 's'),
                           ('tracking_number', 's'), ('carrier_tracking_link_url', 's'), ('location', 's'),
                           ('po_shipping_status', 's'), ('status', 's'), ('invoice_number', 's'),
                           ('invoiced', 's'), ('date_created', 's'), ('last_modified', 's'),
                           ('last_updated', 's'), ('delivery_date', 's'), ('original_delivery_eta', 's'),
                           ('pick_up_date', 's')],
 'po_header_rollup': [('po_number', 's'), ('po_title', 's'), ('po_type', 's'), ('transaction_extid', 's'),
                      ('external_id', 's'), ('buyer', 's'), ('po_status', 's'), ('po_vendor', 's'),
                      ('po_terms', 's'), ('po_cancel_date', 's'), ('po_created_date', 's'),
                      ('po_ship_date', 's'), ('po_original_ship_date', 's'), ('po_original_cancel_date', 's'),
                      ('po_due_date', 't'), ('po_email_sent', 's'), ('po_first_transmission', 's'),
                      ('po_fixed_payment_date', 's'), ('po_is_finalized', 's'), ('record_source_system', 's'),
                      ('po_edit_date', 's'), ('po_edit_fiscal_week_number', 'i'), ('days_to_edit', 'd'),
                      ('po_allocation_channel', 's'), ('vendor_id', 'i'), ('po_date', 's'),
                      ('merchandise_division', 's'), ('season_code', 's'), ('season_year', 's'),
                      ('n_860_last_execution_timestamp', 's'), ('n_850_last_execution_timestamp', 's'),
                      ('discount_amount', 'd'), ('down_payment', 'd'), ('reserved_amount', 'd'),
                      ('shipping_amount', 'd'), ('amount_change', 'd'), ('amount_unbilled', 'd'),
                      ('total__amount', 'd'), ('total_amount_billed', 'd'), ('total_principal', 'd'),
                      ('total_qv_', 'd'), ('total_approved', 'd'), ('refunded_amount', 'd'),
                      ('po_category', 's'), ('location', 's'), ('memo', 's'), ('po_batch_name', 's'),
                      ('line_count', 'i'), ('total_quantity', 'd'), ('remaining_open_quantity', 'd'),
                      ('days_past_due', 'i'), ('due_date', 't'), ('received_amount', 'd'),
                      ('transmitted_po', 's'), ('cost_center', 's'), ('location_code', 's'),
                      ('integration_status', 's'), ('competing_bids', 's'), ('reason_for_purchase', 's'),
                      ('purchase_order_change_status', 's'), ('ready_for_860_transmit', 's'),
                      ('acknowledgment_date', 's'), ('acknowledgment_terms', 's'),
                      ('acknowledgment_scheduled_date', 's'), ('acknowledgment_memo', 's'),
                      ('acknowledgment_type', 's'), ('transaction_purpose', 's'), ('sent_to_chr', 's')],
 'po_line_measures': [('po_number', 's'), ('item_extid', 's'), ('vendor_sku', 's'), ('item_description', 's'),
                      ('po_item_description', 's'), ('expected_arrival_eta_line', 'D'), ('closed', 's'),
                      ('item_count', 'd'), ('original_transmitted_qty', 'd'),
                      ('quantity_received_in_shipment', 'd'), ('number_billed', 'd'),
                      ('unit_of_measure', 's'), ('conversion_rate', 'd'), ('item_unit_price', 's'),
                      ('rate', 's'), ('purchase_price', 'd'), ('discount_amount', 'd'), ('amount', 'd'),
                      ('product_group_name', 's'), ('upc_code', 's'), ('brand_name', 's'), ('options', 'i'),
                      ('line_created_date', 't'), ('quantity_available', 'd'),
                      ('acknowledgment_item_status', 's'), ('transaction_line_id', 'i'),
                      ('inventory_owned_flag', 'b'), ('transaction_expected_arrival_date', 't'),
                      ('acknowledgment_rate', 'd'), ('acknowledgment_scheduled_date', 's'),
                      ('acknowledgment_scheduled_quantity', 'd'), ('acknowledgment_memo', 's'),
                      ('n_2nd_acknowledgment_item_status', 's'), ('n_2nd_acknowledgment_scheduled_date', 't'),
                      ('n_2nd_acknowledgment_schedul_quantity', 'd'), ('asn_record', 's'),
                      ('asn_quantity_shipped', 'd'), ('asn_shipment_date', 's'),
                      ('asn_estimated_delivery_date', 's'), ('demand_amount', 'd'), ('demand_cogs', 'd'),
                      ('demand_quantity', 'd'), ('estimated_cost', 'd'), ('full_price', 'd'),
                      ('shipping_amount', 'd'), ('amount_custom', 'd'), ('amount_foreign', 'd'),
                      ('amount_pending', 'd'), ('original_cogs', 'd'), ('po__rate', 's'),
                      ('quantity_allocated', 'd'), ('quantity_custom', 'd'), ('quantity_difference', 'd'),
                      ('quantity_on_order', 'd'), ('rate_custom', 'd'), ('quantity_in_transaction_unit', 'd'),
                      ('in_transit_window', 's'), ('transit_window_end', 's'), ('qty_in_transit', 'd'),
                      ('on_order_quantity', 'd'), ('on_order_cost', 'd')],
 'po_lines_nested_flat': [('po_number', 's'), ('n_lines', 'i'), ('total_on_order_quantity', 'd'),
                          ('total_on_order_cost', 'd'), ('expected_arrival_date', 'D'),
                          ('total_amount_lines', 'd')],
 'problem_summary_in_order': [('merchandise_division', 's'), ('assigned_to', 's'), ('place', 'i')],
 'publish_round_trip': [('po_number', 's'), ('expected_arrival_date', 'D'), ('n_lines', 'i')],
 'recent_rows': [('carrier_shipping_data_id', 'i'), ('carrier_shipping_data_name', 's'),
                 ('date_created', 't'), ('is_inactive', 's')],
 'replaced_table': [('po_number', 's'), ('line_id', 'i'), ('qty_in_transit', 'd'),
                    ('transit_window_end', 'D'), ('n_versions', 'i')],
 'role_lookups': [('vendor_id', 'i'), ('edi_810', 's'), ('edi_846', 's'), ('edi_850', 's'), ('edi_855', 's'),
                  ('edi_856', 's'), ('edi_860', 's')],
 'staged_po_documents': [('expected_arrival_date', 'D'), ('po_number', 's'), ('po_title', 's'),
                         ('po_type', 's'), ('buyer_name', 's'), ('po_status', 's'), ('cost_center', 's'),
                         ('location', 's'), ('location_code', 's'), ('sent_to_chr', 's'),
                         ('po_first_transmission', 's'), ('po_edit_date', 's'),
                         ('po_edit_fiscal_week_number', 'i'), ('days_past_due', 'i'),
                         ('po_original_ship_date', 's'), ('po_original_cancel_date', 's'), ('po_vendor', 's'),
                         ('season_code', 's'), ('acknowledgment_type', 's'), ('line_count', 'i'),
                         ('total_quantity', 'd'), ('remaining_open_quantity', 'd'), ('received_amount', 'd'),
                         ('n_lines', 'i'), ('total_on_order_cost', 'd'), ('total_on_order_quantity', 'd'),
                         ('ni_submitted_total', 'd'), ('total_amount_lines', 'd'),
                         ('total_amount_billed', 'd'), ('total_principal', 'd'), ('total_qv_', 'd'),
                         ('total_approved', 'd'), ('carrier_shipping_data', 's'), ('n_shipments', 'i'),
                         ('updated_date', 't')],
 'staged_vendor_documents': [('name', 's'), ('internal_vendor_id', 'i'), ('status', 's'),
                             ('custom_vendor_externalid', 's'), ('email', 's'), ('address', 's'),
                             ('n_address', 'i'), ('n_subsidiaries', 'i'), ('n_contacts', 'i'),
                             ('contact_ids', 's'), ('contact_text', 's')],
 'text_price_clean': [('transaction_id', 'i'), ('transaction_line_id', 'i'), ('item_unit_price', 's'),
                      ('price', 'd'), ('rate', 's')],
 'vendor_addresses': [('name', 's'), ('internal_vendor_id', 'i'), ('is_default_bill_address', 's'),
                      ('is_default_ship_address', 's'), ('label', 's'), ('address', 's'),
                      ('is_inactive', 's')],
 'vendor_addresses_live': [('name', 's'), ('internal_vendor_id', 'i'), ('is_default_bill_address', 's'),
                           ('is_default_ship_address', 's'), ('label', 's'), ('address', 's'),
                           ('is_inactive', 's')],
 'vendor_approvals': [('name', 's'), ('internal_vendor_id', 'i'), ('date_created', 't'), ('created_by', 's'),
                      ('finance_status', 's'), ('operations_status', 's')],
 'vendor_approvals_live': [('name', 's'), ('internal_vendor_id', 'i'), ('date_created', 's'),
                           ('created_by', 's'), ('finance_status', 's'), ('operations_status', 's')],
 'vendor_communications': [('name', 's'), ('internal_vendor_id', 'i'), ('date', 't'), ('author_id', 'i'),
                           ('author', 's'), ('recipient_id', 'i'), ('primary_recipient', 's'),
                           ('subject', 's'), ('to_0', 's'), ('from_0', 's'), ('message_type_id', 'i'),
                           ('message', 's')],
 'vendor_communications_live': [('name', 's'), ('internal_vendor_id', 'i'), ('date', 't'), ('author_id', 'i'),
                                ('author', 's'), ('recipient_id', 'i'), ('primary_recipient', 's'),
                                ('subject', 's'), ('to_0', 's'), ('from_0', 's'), ('message_type_id', 'i')],
 'vendor_document_addresses': [('name', 's'), ('companyname', 's'), ('vendor_id', 's'),
                               ('internal_vendor_id', 'i'), ('type', 's'), ('vendor_category', 's'),
                               ('terms', 's'), ('incoterm', 's'), ('comments', 's'), ('email', 's'),
                               ('email_address_for_payment_not', 's'), ('accounting_email', 's'),
                               ('phone', 's'), ('altphone', 's'), ('fax', 's'), ('web_address', 's'),
                               ('address', 's'), ('pur_edi', 's'), ('pur_edi_855_activation_date', 's'),
                               ('pur_edi_850', 's'), ('pur_edi_860', 's'), ('pur_edi_855', 's'),
                               ('pur_edi_856', 's'), ('pur_edi_810', 's'), ('pur_edi_846', 's'),
                               ('pur_edi_capable', 's'), ('pur_creditlimit', 'd'),
                               ('pur_vendor_credit_limit_date', 's'), ('pur_currency', 's'),
                               ('fin_balance', 'd'), ('fin_unbilled_orders', 'd'), ('fin_currency', 's'),
                               ('fin_clerk_name', 's')],
 'vendor_document_contacts': [('internal_vendor_id', 'i'), ('contact_id', 'i'), ('full_name', 's'),
                              ('contact', 's'), ('salutation_MR_MS', 's'), ('contact_name', 's'),
                              ('company_id', 'i'), ('company_name', 's'), ('job_title', 's'),
                              ('comments', 's'), ('private', 's'), ('category', 's'), ('email', 's'),
                              ('altemail', 's'), ('mainphone', 's'), ('officephone', 's'),
                              ('mobilephone', 's'), ('homephone', 's'), ('fax', 's'), ('address', 's'),
                              ('subsidiary_id', 'i'), ('subsidiary', 's'), ('last_sales_activity', 't'),
                              ('supervisor', 's'), ('supervisorphone', 's'), ('assistand', 's'),
                              ('assistantphone', 's'), ('is_default_ship_address', 's'),
                              ('is_default_bill_address', 's'), ('address_tab', 's'), ('isinactive', 's')],
 'vendor_document_flat': [('name', 's'), ('internal_vendor_id', 'i'), ('status', 's'),
                          ('custom_vendor_externalid', 's'), ('email', 's'), ('address', 's'),
                          ('n_address', 'i'), ('n_subsidiaries', 'i'), ('n_contacts', 'i'),
                          ('contact_ids', 's'), ('contact_text', 's')],
 'vendor_fields_in_order': [('tranid', 's'), ('original_cancel_date', 'D'), ('edi_855', 's'), ('place', 'i')],
 'vendor_relationships': [('name', 's'), ('internal_vendor_id', 'i'), ('contact_name', 's'),
                          ('category', 's'), ('job_title', 's'), ('email', 's'), ('phone', 's'),
                          ('contact_id', 'i')],
 'vendor_relationships_live': [('name', 's'), ('internal_vendor_id', 'i'), ('contact_name', 's'),
                               ('category', 's'), ('job_title', 's'), ('email', 's'), ('phone', 's'),
                               ('contact_id', 'i')],
 'vendor_subsidiaries': [('name', 's'), ('internal_vendor_id', 'i'), ('primary_subsidiary', 's'),
                         ('subsidiary', 's'), ('primary', 'b'), ('isinactive', 's'), ('balance', 'd'),
                         ('balance_base', 'd'), ('unbilled_orders', 'd'), ('unbilled_orders_base', 'd'),
                         ('credit_limit', 'd'), ('subsidiary_id', 'i'), ('currency', 's'),
                         ('tax_code', 's')],
 'vendor_subsidiaries_live': [('name', 's'), ('internal_vendor_id', 'i'), ('primary_subsidiary', 's'),
                              ('subsidiary', 's'), ('primary', 'b'), ('isinactive', 's'), ('balance', 'd'),
                              ('balance_base', 'd'), ('unbilled_orders', 'd'), ('unbilled_orders_base', 'd'),
                              ('credit_limit', 'd'), ('subsidiary_id', 'i'), ('currency', 's'),
                              ('tax_code', 's')],
 'vendor_tabs': [('name', 's'), ('companyname', 's'), ('status', 's'), ('vendor_id', 's'),
                 ('internal_vendor_id', 'i'), ('type', 's'), ('vendor_category', 's'), ('terms', 's'),
                 ('incoterm', 's'), ('comments', 's'), ('email', 's'), ('email_address_for_payment_not', 's'),
                 ('accounting_email', 's'), ('phone', 's'), ('altphone', 's'), ('fax', 's'),
                 ('web_address', 's'), ('address', 's'), ('n_address', 'i'), ('address_labels', 's'),
                 ('pur_edi', 's'), ('pur_edi_855_activation_date', 't'), ('pur_edi_850', 's'),
                 ('pur_edi_860', 's'), ('pur_edi_855', 's'), ('pur_edi_856', 's'), ('pur_edi_810', 's'),
                 ('pur_edi_846', 's'), ('pur_edi_capable', 's'), ('pur_creditlimit', 'd'),
                 ('pur_vendor_credit_limit_date', 't'), ('pur_currency', 's'), ('fin_balance', 'd'),
                 ('fin_unbilled_orders', 'd'), ('fin_currency', 's'), ('n_relationships', 'i'),
                 ('relationship_ids', 's'), ('relationship_categories', 's'), ('n_communications', 'i'),
                 ('recipients', 's'), ('n_approvals', 'i'), ('approvals', 's'), ('n_subsidiaries', 'i'),
                 ('subsidiaries', 's')],
 'vendor_tabs_live': [('name', 's'), ('companyname', 's'), ('status', 's'), ('vendor_id', 's'),
                      ('internal_vendor_id', 'i'), ('custom_vendor_externalid', 's'), ('type', 's'),
                      ('vendor_category', 's'), ('terms', 's'), ('incoterm', 's'), ('comments', 's'),
                      ('email', 's'), ('email_address_for_payment_not', 's'), ('accounting_email', 's'),
                      ('phone', 's'), ('altphone', 's'), ('fax', 's'), ('web_address', 's'), ('address', 's'),
                      ('isinactive', 's'), ('n_address', 'i'), ('address_labels', 's'), ('pur_edi', 's'),
                      ('pur_edi_855_activation_date', 's'), ('pur_edi_850', 's'), ('pur_edi_860', 's'),
                      ('pur_edi_855', 's'), ('pur_edi_856', 's'), ('pur_edi_810', 's'), ('pur_edi_846', 's'),
                      ('pur_edi_capable', 's'), ('pur_creditlimit', 'd'),
                      ('pur_vendor_credit_limit_date', 's'), ('pur_currency', 's'), ('fin_balance', 'd'),
                      ('fin_unbilled_orders', 'd'), ('fin_currency', 's'), ('fin_clerk_name', 's'),
                      ('n_relationships', 'i'), ('relationship_ids', 's'), ('relationship_categories', 's'),
                      ('n_communications', 'i'), ('recipients', 's'), ('n_approvals', 'i'),
                      ('approvals', 's'), ('n_subsidiaries', 'i'), ('subsidiaries', 's')],
 'zone_yesterday': [('sku', 's'), ('n_rows', 'i')]}
