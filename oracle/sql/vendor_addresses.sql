-- J06 address tab, one row per element.
SELECT v.name, v.vendor_id AS internal_vendor_id, a.is_default_bill_address, a.is_default_ship_address, a.name AS label, a.address, a.is_inactive
FROM vendors AS v LEFT JOIN address_book AS a ON a.entity_id = v.vendor_id
WHERE companyname IS NOT NULL
