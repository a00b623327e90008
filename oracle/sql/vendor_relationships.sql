-- J06 relationships tab, one row per element: contacts with their types.
SELECT v.name, v.vendor_id AS internal_vendor_id, k.name AS contact_name, k.category, k.title AS job_title, k.email, k.phone, k.contact_id
FROM vendors AS v LEFT JOIN (
  SELECT contacts.*, y.name AS category FROM contacts LEFT JOIN contact_types AS y ON y.contact_id = contacts.contact_id
  WHERE true
) AS k ON k.company_id = v.vendor_id
WHERE companyname IS NOT NULL
