-- J10 address tab, one row per element.
SELECT v.name, v.vendor_id AS internal_vendor_id, a.is_default_bill_address, a.is_default_ship_address, a.name AS label, a.address, a.is_inactive
FROM vendors AS v JOIN address_book AS a ON a.entity_id = v.vendor_id AND NOT a._fivetran_deleted
WHERE companyname IS NOT NULL AND NOT v._fivetran_deleted
  AND EXISTS (SELECT 1 FROM employees AS p WHERE p.employee_id = v.created_by_ven_id AND NOT p._fivetran_deleted)
