-- J10 relationships tab, one row per element: contacts with their types.
SELECT v.name, v.vendor_id AS internal_vendor_id, k.name AS contact_name, k.category, k.title AS job_title, k.email, k.phone, k.contact_id
FROM vendors AS v JOIN (
  SELECT contacts.*, y.name AS category FROM contacts JOIN contact_types AS y ON y.contact_id = contacts.contact_id AND NOT y._fivetran_deleted
  WHERE NOT contacts._fivetran_deleted
) AS k ON k.company_id = v.vendor_id
WHERE companyname IS NOT NULL AND NOT v._fivetran_deleted
  AND EXISTS (SELECT 1 FROM employees AS p WHERE p.employee_id = v.created_by_ven_id AND NOT p._fivetran_deleted)
