-- J15: vendor document = J10 left join the array of its J11 contacts.
WITH vs AS ({{q:vendor_tabs_live}}),
ct AS (
  SELECT company_id, count(*) AS n_contacts,
         string_agg(CAST(contact_id AS VARCHAR), '|' ORDER BY CAST(contact_id AS VARCHAR)) AS contact_ids,
         string_agg(concat_ws(':', name, address_tab, replace(category, '|', ',')), '|'
                    ORDER BY concat_ws(':', name, address_tab, replace(category, '|', ','))) AS contact_text
  FROM ({{q:contact_categories_active}}) x
  WHERE company_id IS NOT NULL AND isinactive = 'No'
  GROUP BY company_id
)
SELECT vs.name, vs.internal_vendor_id, vs.status, vs.custom_vendor_externalid, vs.email, vs.address,
       vs.n_address, vs.n_subsidiaries, ct.n_contacts, ct.contact_ids, ct.contact_text
FROM vs LEFT JOIN ct ON vs.internal_vendor_id = ct.company_id
