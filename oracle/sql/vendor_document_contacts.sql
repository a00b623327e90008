-- J15: the contacts inside each document, all fields.
SELECT vs.internal_vendor_id, k.* EXCLUDE (name, n_category), k.name AS contact_name
FROM ({{q:vendor_tabs_live}}) AS vs JOIN ({{q:contact_categories_active}}) AS k ON k.company_id = vs.internal_vendor_id
