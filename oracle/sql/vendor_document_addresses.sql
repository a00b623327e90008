-- J15: ways to reach the vendor, and its money and purchasing fields.
SELECT name, companyname, vendor_id, internal_vendor_id, type, vendor_category, terms, incoterm, comments, email, email_address_for_payment_not, accounting_email,
       phone, altphone, fax, web_address, address, COLUMNS('pur_.*'), COLUMNS('fin_.*')
FROM ({{q:vendor_tabs_live}}) AS vs
