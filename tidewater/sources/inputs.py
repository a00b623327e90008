"""Declared columns of the ERP tables that the builders read, and their check.

Keys are looked up through casts, so a key may be stored as a number or as text;
times and flags have to be of their declared kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Names and types of the replicated columns.
INPUTS = {
    "transactions": (
        "_fivetran_deleted:boolean acknowledgment_date:timestamp acknowledgment_memo:string "
        "acknowledgment_scheduled_date:timestamp acknowledgment_terms:string acknowledgment_type_id:bigint "
        "allocation_channel_id:bigint amount_change:double amount_unbilled:double cancel_date:timestamp competing_bids:string "
        "currency_id:bigint days_to_edit:double discount_amount:double down_payment:double due_date:timestamp entity_id:bigint "
        "external_id:string first_transmission:string fixed_payment_date:timestamp integration_status_id:bigint "
        "is_finalized:string location_code:string location_id:bigint memo:string merchandise_division_id:bigint "
        "n_850_last_execution_timestamp:timestamp n_860_last_execution_timestamp:timestamp original_cancel_date:timestamp "
        "original_ship_date:timestamp payment_terms_id:bigint po_batch_name:string po_category_id:bigint po_type_id:bigint "
        "purchase_order_change_statu_id:bigint ready_for_860_transmit_id:bigint reason_for_purchase:string "
        "refunded_amount:double reserved_amount:double sales_rep_id:bigint season_code_id:bigint season_year_id:bigint "
        "sent_to_chr:string ship_date:timestamp shipping_amount:double status:string total__amount:double "
        "total_amount_billed:double total_approved:double total_principal:double total_qv_:double trandate:timestamp "
        "tranid:string transaction_extid:string transaction_id:bigint transaction_purpose:string transaction_type:string "
        "transmitted_po:string "
    ),
    "transaction_lines": (
        "_fivetran_deleted:boolean acknowledgment_item_status_id:bigint acknowledgment_memo:string acknowledgment_rate:double "
        "acknowledgment_scheduled_date:timestamp acknowledgment_scheduled_quan:double amount:double amount_custom:double "
        "amount_foreign:double amount_pending:double asn_estimated_delivery_date:timestamp asn_quantity_shipped:double "
        "asn_record:string asn_shipment_date:timestamp brand_id:bigint demand_amount:double demand_cogs:double "
        "demand_quantity:double department_id:bigint discount_amount:double estimated_cost:double "
        "expected_arrival_eta_line:timestamp full_price:double item_count:double item_id:bigint item_unit_price:string "
        "line_created_date:timestamp memo:string n_2nd_acknowledgment_item_s_id:bigint n_2nd_acknowledgment_schedul_0:double "
        "n_2nd_acknowledgment_scheduled:timestamp number_billed:double original_cogs:double original_transmitted_qty:double "
        "period_closed:string po__rate:string product_group_id:bigint purchase_price:double quantity_allocated:double "
        "quantity_available:double quantity_custom:double quantity_difference:double quantity_on_order:double "
        "quantity_received_in_shipment:double rate_custom:double shipping_amount:double transaction_id:bigint "
        "transaction_line_id:bigint unit_of_measure_id:bigint vendor_sku:string "
    ),
    "sb_receipts": (
        "RECORD_SOURCE:string po_number:string po_purchase_order_item_id:bigint received_quantity:double received_sku:string "
    ),
    "sb_inventory": (
        "sku:string snapshot_day:timestamp "
    ),
    "carrier_shipping_data": (
        "carrier_shipping_data_id:bigint carrier_shipping_data_name:string date_created:timestamp is_inactive:string "
        "last_modified_date:timestamp po_shipping_status:string "
    ),
    "carrier_shipments": (
        "carrier_shipping_data_id:bigint carrier_tracking_link_url:string declared_value:double delivery_date:timestamp "
        "invoice_number:string invoiced:string last_modified_date:timestamp last_updated:timestamp location_0:string "
        "original_delivery_eta:timestamp pallet_count:double pick_up_date:timestamp shipment_id:string shipping_cost:double "
        "status:string tracking_number:string "
    ),
    "entity": (
        "_fivetran_deleted:boolean edi_856_id:bigint entity_id:bigint full_name:string name:string "
    ),
    "employees": (
        "_fivetran_deleted:boolean email:string employee_id:bigint full_name:string "
    ),
    "vendors": (
        "_fivetran_deleted:boolean accounting_clerk_id:bigint accounting_email:string altphone:string billaddress:string "
        "comments:string companyname:string created_by_ven_id:bigint creditlimit:double currency_id:bigint "
        "custom_vendor_externalid:string date_created:timestamp edi:string edi_810_id:bigint edi_846_id:bigint "
        "edi_850_id:bigint edi_855_activation_date:timestamp edi_855_id:bigint edi_856_id:bigint edi_860_id:bigint "
        "edi_capable:string email:string email_address_for_payment_not:string fax:string finance_status_ven_id:bigint "
        "incoterm:string is_person:string isinactive:string name:string operations_status_ven_id:bigint payment_terms_id:bigint "
        "phone:string subsidiary:bigint url:string vendor_credit_limit_date:timestamp vendor_id:bigint vendor_type_id:bigint "
    ),
    "companies": (
        "company_id:bigint companyname:string "
    ),
    "vendor_subsidiary_map": (
        "_fivetran_deleted:boolean balance:double balance_base:double credit_limit:double subsidiary_id:bigint "
        "unbilled_orders:double unbilled_orders_base:double vendor_id:bigint "
    ),
    "address_book": (
        "_fivetran_deleted:boolean address:string entity_id:bigint is_default_bill_address:string "
        "is_default_ship_address:string is_inactive:string name:string "
    ),
    "contacts": (
        "_fivetran_deleted:boolean address:string altemail:string assistant_id:bigint assistantphone:string comments:string "
        "company_id:bigint contact_id:bigint email:string fax:string firstname:string full_name:string homephone:string "
        "is_private:string isinactive:string last_sales_activity:timestamp lastname:string mobilephone:string name:string "
        "officephone:string phone:string salutation:string subsidiary:bigint supervisior_id:bigint supervisorphone:string "
        "title:string "
    ),
    "contact_types": (
        "_fivetran_deleted:boolean contact_id:bigint name:string "
    ),
    "message": (
        "_fivetran_deleted:boolean author_id:bigint company_id:bigint date_0:timestamp from_0:string message:string "
        "message_type_id:bigint recipient_id:bigint subject:string to_0:string "
    ),
    "items_cv": (
        "axis_1_option_header_id:bigint item_extid:string item_id:bigint salesdescription:string uom_id:bigint upc_code:string "
    ),
    "uom": (
        "conversion_rate:double name:string uom_id:bigint "
    ),
    "brand": (
        "_fivetran_deleted:boolean brand_id:bigint brand_name:string "
    ),
    "product_group": (
        "_fivetran_deleted:boolean product_group_id:bigint product_group_name:string "
    ),
    "merchandise_division": (
        "_fivetran_deleted:boolean assigned_to_id:bigint merchandise_division_id:bigint merchandise_division_name:string "
    ),
    "locations": (
        "_fivetran_deleted:boolean full_name:string location_code:string location_id:bigint "
    ),
    "departments": (
        "department_id:bigint full_name:string "
    ),
    "subsidiaries": (
        "_fivetran_deleted:boolean isinactive:string name:string state_tax_number:string subsidiary_id:bigint "
    ),
    "currencies": (
        "_fivetran_deleted:boolean currency_id:bigint name:string "
    ),
    "payment_terms": (
        "name:string payment_terms_id:bigint "
    ),
    "vendor_types": (
        "name:string vendor_type_id:bigint "
    ),
    "dim_dates": (
        "REALIGNED_FISCAL_WEEK_NO:bigint calendar_date:timestamp "
    ),
    "season": (
        "list_id:bigint list_item_name:string "
    ),
    "year1": (
        "list_id:bigint list_item_name:string "
    ),
    "po_types": (
        "_fivetran_deleted:boolean list_id:bigint list_item_name:string "
    ),
    "edi_document_type_status": (
        "list_id:bigint list_item_name:string "
    ),
    "acknowledgment_item_statuses": (
        "list_id:bigint list_item_name:string "
    ),
    "acknowledgment_types": (
        "list_id:bigint list_item_name:string "
    ),
    "integrationstatuses": (
        "list_id:bigint list_item_name:string "
    ),
    "ready_for_860_transmit": (
        "list_id:bigint list_item_name:string "
    ),
    "purchase_order_change_status": (
        "list_id:bigint list_item_name:string "
    ),
    "allocation_channel": (
        "list_id:bigint list_item_name:string "
    ),
    "po_category": (
        "list_id:bigint list_item_name:string "
    ),
    "finance_status": (
        "_fivetran_deleted:boolean list_id:bigint list_item_name:string "
    ),
    "operations_status": (
        "_fivetran_deleted:boolean list_id:bigint list_item_name:string "
    ),
    "edi_856_asn": (
        "_fivetran_deleted:boolean asn_vendor_id:bigint bill_of_lading_number:string carrier_alpha_code:string "
        "carrier_equipment_number:string carrier_pro_number:string carrier_routing:string carrier_trans_method_code:string "
        "date_created:timestamp edi_856_asn_extid:string edi_856_asn_file:string edi_856_asn_id:bigint edi_856_asn_name:string "
        "equipment_description_code:string estimated_delivery_date:timestamp fob_pay_code:string is_inactive:string "
        "lading_quantity:double last_modified_date:timestamp packing_material:string packing_medium:string parent_id:bigint "
        "ship_from_address:string ship_from_address_1:string ship_from_address_2:string ship_from_address_3:string "
        "ship_from_address_4:string ship_from_address_name:string ship_from_city:string ship_from_country:string "
        "ship_from_postal_code:string ship_from_state:string ship_to_address:string ship_to_address_1:string "
        "ship_to_address_2:string ship_to_address_3:string ship_to_address_4:string ship_to_address_name:string "
        "ship_to_city:string ship_to_country:string ship_to_postal_code:string ship_to_state:string shipment_date:timestamp "
        "shipment_id:string shipment_notice_date:timestamp shipment_notice_time:string status_code:string "
        "total_line_item_number:bigint tset_purpose_code:string vendor_idname_id:bigint weight:double weight_qualifier:string "
        "weight_uom:string "
    ),
    "edi_856_asn_line": (
        "_fivetran_deleted:boolean asn_vendor_id:bigint carrier_package_id:string date_created:timestamp edi_856_asn_id:bigint "
        "edi_856_asn_line_extid:string edi_856_asn_line_id:bigint estimated_delivery_date:timestamp is_inactive:string "
        "last_modified_date:timestamp line_number:bigint line_ship_quantity:double mpn:string order_qty_uom:string "
        "pack_level_type:string pack_value:string pack_weight:double pack_weight_uom:string packing_material:string "
        "packing_medium:string parent_id:bigint po_md_id:bigint po_type_id:bigint product_description:string "
        "purchase_order_date:timestamp purchase_order_id:bigint purchase_order_id_0:string quantity_ordered:double "
        "ship_qty_uom:string shipment_date:timestamp shipping_serial_id:string sku:string upc:string vendor_part_number:string "
    ),
}


def columns(name: str) -> dict[str, str]:
    return dict(x.split(":") for x in INPUTS[name].split())


def checked(df: DataFrame, name: str) -> DataFrame:
    """``df``, after its declared columns and kinds have been checked (schema only, no job)."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    wrong = []
    for column, kind in columns(name).items():
        found = have.get(column.lower())
        if found is None:
            wrong.append(f"{column} is missing")
        elif kind in ("timestamp", "date") and not isinstance(found, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            wrong.append(f"{column} is {found.simpleString()}, not {kind}")
        elif (kind == "boolean") != isinstance(found, T.BooleanType):
            wrong.append(f"{column} is {found.simpleString()}, not {kind}")
    if wrong:
        raise ValueError(f"{name}: " + "; ".join(wrong))
    return df
