"""Declared output schemas of the 15 builders (generated by tools/gen_schemas.py,
checked by tests/test_schemas.py): column names, order, types and nested fields."""

OUTPUTS = {
    'asn_details': (
        'struct<vendor:string,brand:string,po_date:timestamp,ship_date:timestamp,cancel_date:timestamp,po_num'
        'ber:string,merchandise_division:string,po_type:string,season_code:string,season_year:string,buyer:st'
        'ring,line_id:bigint,sku:string,vendor_sku:string,upc:string,memo:string,expected_arrival_eta_line:ti'
        'mestamp,quantity_in_transaction_unit:double,original_transmitted_qty:double,quantity_fulfilled_recei'
        'ved:double,quantity_billed:double,qty_in_transit:double,units:string,rate:string,discount_amount:dou'
        'ble,purchase_price:double,amount:double,asn_record:string,asn_quantity_shipped:double,asn_shipment_d'
        'ate:timestamp,asn_estimated_delivery_date:timestamp,n_860_sent:timestamp,status:string,in_transit_wi'
        'ndow:string,transit_window_end:date>'
    ),
    'asn_summary': (
        'struct<merchandise_division:string,count_vendors:bigint,count_orders:bigint,assigned_to:string,count'
        '_problems_lines:bigint>'
    ),
    'carrier_shipment_info_chr': (
        'struct<name:string,vendor:string,po_number:string,po_shipping_status:string,date_created:timestamp,l'
        'ast_modified:timestamp,inactive:string,carrier_shipping_data:string,last_updated:timestamp,shipment_'
        'id:string,status:string,delivery_date:timestamp,tracking_number:string,carrier_tracking_link_url:str'
        'ing,tracking_number_html:string,original_delivery_eta:timestamp,pick_up_date:timestamp,location:stri'
        'ng,pallet_count:double,declared_value:double,shipping_cost:double,invoice_number:string,invoiced:str'
        'ing>'
    ),
    'contact_details': (
        'struct<contact_id:bigint,full_name:string,contact:string,salutation_MR_MS:string,name:string,company'
        '_id:bigint,company:string,job_title:string,comments:string,private:string,category:array<string>,ema'
        'il:string,altemail:string,mainphone:string,officephone:string,mobilephone:string,homephone:string,fa'
        'x:string,address:string,subsidiary_id:bigint,subsidiary:string,last_sales_activity:timestamp,supervi'
        'sor:string,supervisorphone:string,assistand:string,assistantphone:string,is_default_ship_address:str'
        'ing,is_default_bill_address:string,address1:string,isinactive:string>'
    ),
    'edi_chr_po_vendor_fields': (
        'struct<tranid:string,original_ship_date:date,original_cancel_date:date,Carrier_Shipping_Data:string,'
        'sent_to_chr:string,n_860_last_execution_timestamp:string,location_code:bigint,integration_status_id:'
        'string,ready_for_860_transmit_id:string,n_850_last_execution_timestamp:string,acknowledgment_date:st'
        'ring,acknowledgment_terms:string,acknowledgment_scheduled_date:timestamp,acknowledgment_memo:string,'
        'acknowledgment_type_id:string,acknowledgment_item_status:string,acknowledgment_rate:double,acknowled'
        'gment_scheduled_date1:timestamp,acknowledgment_scheduled_quan:double,acknowledgment_memo1:string,n2n'
        'd_Acknowledgment_Item_Status:bigint,n_2nd_acknowledgment_scheduled_date:timestamp,n_2nd_acknowledgme'
        'nt_scheduled_quantity:double,asn_record:string,asn_quantity_shipped:double,asn_shipment_date:timesta'
        'mp,asn_estimated_delivery_date:timestamp,edi:string,edi_810:string,edi_846:string,edi_850:string,edi'
        '_855:string,edi_855_activation_date:string,edi_856:string,edi_860:string,edi_capable:string>'
    ),
    'vendor_contacts': (
        'struct<name:string,companyname:string,status:string,vendor_id:string,internal_vendor_id:bigint,type:'
        'string,vendor_category:string,terms:string,incoterm:string,comments:string,email:string,email_addres'
        's_for_payment_not:string,accounting_email:string,phone:string,altphone:string,fax:string,web_address'
        ':string,address:string,address_tab:array<struct<is_default_bill_address:string,is_default_ship_addre'
        'ss:string,label:string,address:string,is_inactive:string>>,purchasing_tab:struct<edi:string,edi_855_'
        'activation_date:timestamp,edi_850:string,edi_860:string,edi_855:string,edi_856:string,edi_810:string'
        ',edi_846:string,edi_capable:string,creditlimit:double,vendor_credit_limit_date:timestamp,currency:st'
        'ring>,financials_tab:struct<balance:double,unbilled_orders:double,currency:string>,relationships_tab'
        ':array<struct<contact_name:string,category:string,job_title:string,email:string,phone:string,contact'
        '_id:bigint>>,communications_tab:array<struct<date:timestamp,author_id:bigint,author:string,recipient'
        '_id:bigint,primary_recipient:string,subject:string,to_0:string,from_0:string,message_type_id:bigint,'
        'message:string>>,approvals_tab:array<struct<date_created:timestamp,created_by:string,finance_status:'
        'string,operations_status:string>>,subsidiaries_tab:array<struct<primary_subsidiary:string,subsidiary'
        ':string,primary:boolean,isinactive:string,balance:double,balance_base:double,unbilled_orders:double,'
        'unbilled_orders_base:double,credit_limit:double,subsidiary_id:bigint,currency:string,tax_code:string'
        '>>>'
    ),
    'purchase_orders_all': (
        'struct<po_number:string,po_title:string,po_type:string,transaction_extid:string,external_id:string,b'
        'uyer:string,po_status:string,po_vendor:string,po_terms:string,po_cancel_date:string,po_created_date:'
        'string,po_ship_date:string,po_original_ship_date:string,po_original_cancel_date:string,po_due_date:t'
        'imestamp,po_email_sent:string,po_first_transmission:string,po_fixed_payment_date:string,po_is_finali'
        'zed:string,record_source_system:string,po_edit_date:string,po_edit_fiscal_week_number:bigint,days_to'
        '_edit:double,po_allocation_channel:string,vendor_id:bigint,po_date:string,merchandise_division:strin'
        'g,season_code:string,season_year:string,n_860_last_execution_timestamp:string,n_850_last_execution_t'
        'imestamp:string,discount_amount:double,down_payment:double,reserved_amount:double,shipping_amount:do'
        'uble,amount_change:double,amount_unbilled:double,total__amount:double,total_amount_billed:double,tot'
        'al_principal:double,total_qv_:double,total_approved:double,refunded_amount:double,po_category:string'
        ',location:string,memo:string,po_batch_name:string,line_count:bigint,total_quantity:double,remaining_'
        'open_quantity:double,days_past_due:int,due_date:timestamp,received_amount:double,transmitted_po:stri'
        'ng,cost_center:string,location_code:string,integration_status:string,competing_bids:string,reason_fo'
        'r_purchase:string,purchase_order_change_status:string,ready_for_860_transmit:string,acknowledgment_d'
        'ate:string,acknowledgment_terms:string,acknowledgment_scheduled_date:string,acknowledgment_memo:stri'
        'ng,acknowledgment_type:string,transaction_purpose:string,sent_to_chr:string>'
    ),
    'po_lines_nested': (
        'struct<po_number:string,po_lines:array<struct<item_extid:string,vendor_sku:string,item_description:s'
        'tring,po_item_description:string,expected_arrival_eta_line:date,closed:string,item_count:double,orig'
        'inal_transmitted_qty:double,quantity_received_in_shipment:double,number_billed:double,unit_of_measur'
        'e:string,conversion_rate:double,item_unit_price:string,rate:string,purchase_price:double,discount_am'
        'ount:double,amount:double,product_group_name:string,upc_code:string,brand_name:string,options:bigint'
        ',line_created_date:timestamp,quantity_available:double,acknowledgment_item_status:string,transaction'
        '_line_id:bigint,inventory_owned_flag:boolean,transaction_expected_arrival_date:timestamp,acknowledgm'
        'ent_rate:double,acknowledgment_scheduled_date:string,acknowledgment_scheduled_quantity:double,acknow'
        'ledgment_memo:string,n_2nd_acknowledgment_item_status:string,n_2nd_acknowledgment_scheduled_date:tim'
        'estamp,n_2nd_acknowledgment_schedul_quantity:double,asn_record:string,asn_quantity_shipped:double,as'
        'n_shipment_date:string,asn_estimated_delivery_date:string,demand_amount:double,demand_cogs:double,de'
        'mand_quantity:double,estimated_cost:double,full_price:double,shipping_amount:double,amount_custom:do'
        'uble,amount_foreign:double,amount_pending:double,original_cogs:double,po__rate:string,quantity_alloc'
        'ated:double,quantity_custom:double,quantity_difference:double,quantity_on_order:double,rate_custom:d'
        'ouble,quantity_in_transaction_unit:double,in_transit_window:string,transit_window_end:string,qty_in_'
        'transit:double,on_order_quantity:double,on_order_cost:double>>,total_on_order_quantity:double,total_'
        'on_order_cost:double,expected_arrival_date:date,total_amount_lines:double>'
    ),
    'carrier_shipment_chr_nested': (
        'struct<carrier_shipping_data:string,po_number:string,vendor:string,custom_po_number:string,shipment_'
        'details:array<struct<shipment_id:string,pallet_count:double,declared_value:double,shipping_cost:doub'
        'le,inactive:string,tracking:struct<tracking_number:string,carrier_tracking_link_url:string,location:'
        'string,po_shipping_status:string,status:string>,invoice:struct<invoice_number:string,invoiced:string'
        '>,shipment_dates:struct<date_created:string,last_modified:string,last_updated:string,delivery_date:s'
        'tring,original_delivery_eta:string,pick_up_date:string>>>>'
    ),
    'vendor_contacts_stage': (
        'struct<name:string,companyname:string,status:string,vendor_id:string,internal_vendor_id:bigint,custo'
        'm_vendor_externalid:string,type:string,vendor_category:string,terms:string,incoterm:string,comments:'
        'string,email:string,email_address_for_payment_not:string,accounting_email:string,phone:string,altpho'
        'ne:string,fax:string,web_address:string,address:string,isinactive:string,address_tab:array<struct<is'
        '_default_bill_address:string,is_default_ship_address:string,label:string,address:string,is_inactive:'
        'string>>,purchasing_tab:struct<edi:string,edi_855_activation_date:string,edi_850:string,edi_860:stri'
        'ng,edi_855:string,edi_856:string,edi_810:string,edi_846:string,edi_capable:string,creditlimit:double'
        ',vendor_credit_limit_date:string,currency:string>,financials_tab:struct<balance:double,unbilled_orde'
        'rs:double,currency:string,accounting_clerk_id:bigint,accounting_clerk_email:string,accounting_clerk_'
        'name:string>,relationships_tab:array<struct<contact_name:string,category:string,job_title:string,ema'
        'il:string,phone:string,contact_id:bigint>>,communications_tab:array<struct<date:timestamp,author_id:'
        'bigint,author:string,recipient_id:bigint,primary_recipient:string,subject:string,to_0:string,from_0:'
        'string,message_type_id:bigint>>,approvals_tab:array<struct<date_created:string,created_by:string,fin'
        'ance_status:string,operations_status:string>>,subsidiaries_tab:array<struct<primary_subsidiary:strin'
        'g,subsidiary:string,primary:boolean,isinactive:string,balance:double,balance_base:double,unbilled_or'
        'ders:double,unbilled_orders_base:double,credit_limit:double,subsidiary_id:bigint,currency:string,tax'
        '_code:string>>>'
    ),
    'contact_details_stage': (
        'struct<contact_id:bigint,full_name:string,contact:string,salutation_MR_MS:string,name:string,company'
        '_id:bigint,company_name:string,job_title:string,comments:string,private:string,category:array<string'
        '>,email:string,altemail:string,mainphone:string,officephone:string,mobilephone:string,homephone:stri'
        'ng,fax:string,address:string,subsidiary_id:bigint,subsidiary:string,last_sales_activity:timestamp,su'
        'pervisor:string,supervisorphone:string,assistand:string,assistantphone:string,is_default_ship_addres'
        's:string,is_default_bill_address:string,address_tab:string,isinactive:string>'
    ),
    'purchase_order_nested': (
        'struct<expected_arrival_date:date,po_number:string,purchase_oder:struct<po_title:string,po_type:stri'
        'ng,transaction_extid:string,external_id:string,memo:string,buyer_name:string,po_status:string,po_ter'
        'ms:string,down_payment:double,po_email_sent:string,po_is_finalized:string,po_allocation_channel:stri'
        'ng,merchandise_division:string,location_code:string,integration_status:string,po_first_transmission:'
        'string,ready_for_860_transmit:string,record_source_system:string,po_category:string,location:string,'
        'po_batch_name:string,purchase_order_change_status:string,reason_for_purchase:string,competing_bids:s'
        'tring,cost_center:string,transmitted_po:string,sent_to_chr:string,po_dates:struct<po_created_date:st'
        'ring,po_date:string,po_cancel_date:string,po_ship_date:string,po_original_ship_date:string,po_origin'
        'al_cancel_date:string,po_due_date:timestamp,po_fixed_payment_date:string,po_edit_date:string,days_to'
        '_edit:double,po_edit_fiscal_week_number:bigint,n_860_last_execution_timestamp:string,n_850_last_exec'
        'ution_timestamp:string,days_past_due:int,transaction_purpose:string>,po_vendor:struct<po_vendor_id:b'
        'igint,po_vendor:string>,po_season:struct<season_code:string,season_year:string>,acknowledgment:struc'
        't<acknowledgment_date:string,acknowledgment_terms:string,acknowledgment_scheduled_date:string,acknow'
        'ledgment_memo:string,acknowledgment_type:string>,po_amounts:struct<line_count:bigint,total_quantity:'
        'double,remaining_open_quantity:double,received_amount:double,discount_amount:double,reserved_amount:'
        'double,shipping_amount:double,amount_change:double,amount_unbilled:double,refunded_amount:double>,po'
        '_lines:array<struct<item_extid:string,vendor_sku:string,item_description:string,po_item_description:'
        'string,expected_arrival_eta_line:date,closed:string,item_count:double,original_transmitted_qty:doubl'
        'e,quantity_received_in_shipment:double,number_billed:double,unit_of_measure:string,conversion_rate:d'
        'ouble,item_unit_price:string,rate:string,purchase_price:double,discount_amount:double,amount:double,'
        'product_group_name:string,upc_code:string,brand_name:string,options:bigint,line_created_date:timesta'
        'mp,quantity_available:double,acknowledgment_item_status:string,transaction_line_id:bigint,inventory_'
        'owned_flag:boolean,transaction_expected_arrival_date:timestamp,acknowledgment_rate:double,acknowledg'
        'ment_scheduled_date:string,acknowledgment_scheduled_quantity:double,acknowledgment_memo:string,n_2nd'
        '_acknowledgment_item_status:string,n_2nd_acknowledgment_scheduled_date:timestamp,n_2nd_acknowledgmen'
        't_schedul_quantity:double,asn_record:string,asn_quantity_shipped:double,asn_shipment_date:string,asn'
        '_estimated_delivery_date:string,demand_amount:double,demand_cogs:double,demand_quantity:double,estim'
        'ated_cost:double,full_price:double,shipping_amount:double,amount_custom:double,amount_foreign:double'
        ',amount_pending:double,original_cogs:double,po__rate:string,quantity_allocated:double,quantity_custo'
        'm:double,quantity_difference:double,quantity_on_order:double,rate_custom:double,quantity_in_transact'
        'ion_unit:double,in_transit_window:string,transit_window_end:string,qty_in_transit:double,on_order_qu'
        'antity:double,on_order_cost:double>>>,totals:struct<total_on_order_cost:double,total_on_order_quanti'
        'ty:double,ni_submitted_total:double,total_amount_lines:double,total_amount_billed:double,total_princ'
        'ipal:double,total_qv_:double,total_approved:double>,carrier_shipment_chr:struct<carrier_shipping_dat'
        'a:string,shipment_details:array<struct<shipment_id:string,pallet_count:double,declared_value:double,'
        'shipping_cost:double,inactive:string,tracking:struct<tracking_number:string,carrier_tracking_link_ur'
        'l:string,location:string,po_shipping_status:string,status:string>,invoice:struct<invoice_number:stri'
        'ng,invoiced:string>,shipment_dates:struct<date_created:string,last_modified:string,last_updated:stri'
        'ng,delivery_date:string,original_delivery_eta:string,pick_up_date:string>>>>,created_date:timestamp,'
        'updated_date:timestamp>'
    ),
    'vendor_edi_856_asn': (
        'struct<edi_856_asn_id:bigint,asn_vendor_id:bigint,bill_of_lading_number:string,carrier_alpha_code:st'
        'ring,carrier_equipment_number:string,carrier_pro_number:string,carrier_routing:string,carrier_trans_'
        'method_code:string,date_created:string,edi_856_asn_extid:string,edi_856_asn_file:string,edi_856_asn_'
        'name:string,equipment_description_code:string,estimated_delivery_date:string,fob_pay_code:string,is_'
        'inactive:boolean,lading_quantity:double,last_modified_date:string,packing_material:string,packing_me'
        'dium:string,parent_id:bigint,ship_from_address:string,ship_from_address_1:string,ship_from_address_2'
        ':string,ship_from_address_3:string,ship_from_address_4:string,ship_from_address_name:string,ship_fro'
        'm_city:string,ship_from_country:string,ship_from_postal_code:string,ship_from_state:string,ship_to_a'
        'ddress:string,ship_to_address_1:string,ship_to_address_2:string,ship_to_address_3:string,ship_to_add'
        'ress_4:string,ship_to_address_name:string,ship_to_city:string,ship_to_country:string,ship_to_postal_'
        'code:string,ship_to_state:string,shipment_date:string,shipment_id:string,shipment_notice_date:string'
        ',shipment_notice_time:string,status_code:string,total_line_item_number:bigint,tset_purpose_code:stri'
        'ng,vendor_idname_id:bigint,weight:double,weight_qualifier:string,weight_uom:string>'
    ),
    'vendor_edi_856_asn_line': (
        'struct<edi_856_asn_line_id:bigint,asn_vendor_id:bigint,carrier_package_id:string,date_created:string'
        ',edi_856_asn_id:bigint,edi_856_asn_line_extid:string,estimated_delivery_date:string,is_inactive:bool'
        'ean,last_modified_date:string,line_number:bigint,line_ship_quantity:double,mpn:string,order_qty_uom:'
        'string,pack_level_type:string,pack_value:string,pack_weight:double,pack_weight_uom:string,packing_ma'
        'terial:string,packing_medium:string,parent_id:bigint,po_md_id:bigint,merchandise_division_name:strin'
        'g,po_type_id:bigint,po_type:string,product_description:string,purchase_order_date:string,purchase_or'
        'der_id:bigint,po_number:string,po_internal_id:double,ship_qty_uom:string,shipment_date:string,shippi'
        'ng_serial_id:string,sku:string,upc:string,vendor_part_number:string>'
    ),
    'vendor_contacts_nested': (
        'struct<name:string,companyname:string,status:string,vendor_id:string,internal_vendor_id:bigint,custo'
        'm_vendor_externalid:string,type:string,vendor_category:string,terms:string,incoterm:string,comments:'
        'string,email_phone_address:struct<email:string,email_address_for_payment_not:string,accounting_email'
        ':string,phone:string,altphone:string,fax:string,web_address:string,address:string>,address_tab:array'
        '<struct<is_default_bill_address:string,is_default_ship_address:string,label:string,address:string,is'
        '_inactive:string>>,purchasing_tab:struct<edi:string,edi_855_activation_date:string,edi_850:string,ed'
        'i_860:string,edi_855:string,edi_856:string,edi_810:string,edi_846:string,edi_capable:string,creditli'
        'mit:double,vendor_credit_limit_date:string,currency:string>,financials_tab:struct<balance:double,unb'
        'illed_orders:double,currency:string,accounting_clerk_id:bigint,accounting_clerk_email:string,account'
        'ing_clerk_name:string>,relationships_tab:array<struct<contact_name:string,category:string,job_title:'
        'string,email:string,phone:string,contact_id:bigint>>,communications_tab:array<struct<date:timestamp,'
        'author_id:bigint,author:string,recipient_id:bigint,primary_recipient:string,subject:string,to_0:stri'
        'ng,from_0:string,message_type_id:bigint>>,approvals_tab:array<struct<date_created:string,created_by:'
        'string,finance_status:string,operations_status:string>>,subsidiaries_tab:array<struct<primary_subsid'
        'iary:string,subsidiary:string,primary:boolean,isinactive:string,balance:double,balance_base:double,u'
        'nbilled_orders:double,unbilled_orders_base:double,credit_limit:double,subsidiary_id:bigint,currency:'
        'string,tax_code:string>>,contacts:array<struct<contact_id:bigint,full_name:string,contact:string,sal'
        'utation_MR_MS:string,contact_name:string,company_id:bigint,company_name:string,job_title:string,comm'
        'ents:string,private:string,category:array<string>,email:string,altemail:string,mainphone:string,offi'
        'cephone:string,mobilephone:string,homephone:string,fax:string,address:string,subsidiary_id:bigint,su'
        'bsidiary:string,last_sales_activity:timestamp,supervisor:string,supervisorphone:string,assistand:str'
        'ing,assistantphone:string,is_default_ship_address:string,is_default_bill_address:string,address_tab:'
        'string,isinactive:string>>>'
    ),
}
