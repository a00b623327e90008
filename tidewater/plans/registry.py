"""The 15 builders under the reference's table names, each as ``(t, as_of) -> DataFrame``."""

from tidewater.plans import asn, compliance

BUILDERS = {
    "asn_details": asn.asn_details,
    "asn_summary": asn.asn_summary,
    "carrier_shipment_info_chr": asn.carrier_shipment_info,
    "contact_details": asn.contact_details,
    "edi_chr_po_vendor_fields": asn.edi_po_vendor_fields,
    "vendor_contacts": asn.vendor_contacts,
    "purchase_orders_all": compliance.purchase_orders_all,
    "po_lines_nested": compliance.po_lines_nested,
    "carrier_shipment_chr_nested": lambda t, as_of=None: compliance.carrier_shipments_nested(t),
    "vendor_contacts_stage": lambda t, as_of=None: compliance.vendor_contacts_stage(t),
    "contact_details_stage": lambda t, as_of=None: compliance.contact_details_stage(t),
    "purchase_order_nested": compliance.po_document,
    "vendor_edi_856_asn": lambda t, as_of=None: compliance.edi_856_asn(t),
    "vendor_edi_856_asn_line": lambda t, as_of=None: compliance.edi_856_asn_line(t),
    "vendor_contacts_nested": compliance.vendor_document,
}

# Top-level column counts of the reference's tables.
COLUMNS = {
    "asn_details": 35, "asn_summary": 5, "carrier_shipment_info_chr": 23, "contact_details": 30,
    "edi_chr_po_vendor_fields": 36, "vendor_contacts": 25, "purchase_orders_all": 68, "po_lines_nested": 6,
    "carrier_shipment_chr_nested": 5, "vendor_contacts_stage": 27, "contact_details_stage": 30,
    "purchase_order_nested": 7, "vendor_edi_856_asn": 52, "vendor_edi_856_asn_line": 35,
    "vendor_contacts_nested": 20,
}
