-- J06: the vendor documents, tabs as sizes and sorted texts of their elements.
WITH code AS (SELECT map(list(list_id), list(list_item_name)) AS m FROM edi_document_type_status),
money AS (
  SELECT v.vendor_id, abs(m.balance) AS balance, abs(m.unbilled_orders) AS unbilled, u.name AS currency,
         (SELECT full_name FROM employees WHERE employee_id = v.accounting_clerk_id) AS clerk
  FROM vendors AS v LEFT JOIN currencies AS u ON u.currency_id = v.currency_id
  LEFT JOIN vendor_subsidiary_map AS m ON m.vendor_id = v.vendor_id
),
address AS (SELECT internal_vendor_id, count(*) AS n_address, string_agg(concat_ws(':', label, address, is_inactive), '|' ORDER BY concat_ws(':', label, address, is_inactive)) AS address_labels FROM ({{q:vendor_addresses}}) AS x GROUP BY internal_vendor_id),
relation AS (SELECT internal_vendor_id, count(*) AS n_relationships, string_agg(coalesce(CAST(contact_id AS VARCHAR), '∅'), '|' ORDER BY coalesce(CAST(contact_id AS VARCHAR), '∅')) AS relationship_ids, string_agg(coalesce(category, '∅'), '|' ORDER BY coalesce(category, '∅')) AS relationship_categories FROM ({{q:vendor_relationships}}) AS x GROUP BY internal_vendor_id),
communication AS (SELECT internal_vendor_id, count(*) AS n_communications, string_agg(coalesce(primary_recipient, '∅'), '|' ORDER BY coalesce(primary_recipient, '∅')) AS recipients FROM ({{q:vendor_communications}}) AS x GROUP BY internal_vendor_id),
approval AS (SELECT internal_vendor_id, count(*) AS n_approvals, string_agg(concat_ws(':', created_by, finance_status, operations_status), '|' ORDER BY concat_ws(':', created_by, finance_status, operations_status)) AS approvals FROM ({{q:vendor_approvals}}) AS x GROUP BY internal_vendor_id),
subsidiary AS (SELECT internal_vendor_id, count(*) AS n_subsidiaries, string_agg(concat_ws(':', subsidiary, CAST("primary" AS VARCHAR), CAST(subsidiary_id AS VARCHAR)), '|' ORDER BY concat_ws(':', subsidiary, CAST("primary" AS VARCHAR), CAST(subsidiary_id AS VARCHAR))) AS subsidiaries FROM ({{q:vendor_subsidiaries}}) AS x GROUP BY internal_vendor_id)
SELECT
  v.name, v.companyname, if(v.isinactive = 'No', 'Active', 'Inactive') AS status, v.name AS vendor_id, v.vendor_id AS internal_vendor_id, 
  if(v.is_person = 'No', 'Company', 'Individual') AS type, (SELECT name FROM vendor_types AS y WHERE y.vendor_type_id = v.vendor_type_id) AS vendor_category,
  (SELECT name FROM payment_terms AS y WHERE y.payment_terms_id = v.payment_terms_id) AS terms, v.incoterm, v.comments, v.email,
  v.email_address_for_payment_not, v.accounting_email, v.phone, v.altphone, v.fax, v.url AS web_address, v.billaddress AS address,
  n_address, address_labels, v.edi AS pur_edi, v.edi_855_activation_date AS pur_edi_855_activation_date, code.m[v.edi_850_id] AS pur_edi_850, code.m[v.edi_860_id] AS pur_edi_860, code.m[v.edi_855_id] AS pur_edi_855, code.m[v.edi_856_id] AS pur_edi_856, code.m[v.edi_810_id] AS pur_edi_810, code.m[v.edi_846_id] AS pur_edi_846,
  v.edi_capable AS pur_edi_capable, v.creditlimit AS pur_creditlimit, v.vendor_credit_limit_date AS pur_vendor_credit_limit_date, u.name AS pur_currency,
  f.balance AS fin_balance, f.unbilled AS fin_unbilled_orders, f.currency AS fin_currency,
  n_relationships, relationship_ids, relationship_categories, n_communications, recipients, n_approvals, approvals, n_subsidiaries, subsidiaries
FROM vendors AS v CROSS JOIN code
LEFT JOIN currencies AS u ON u.currency_id = v.currency_id
LEFT JOIN money AS f ON f.vendor_id = v.vendor_id
LEFT JOIN address ON address.internal_vendor_id = v.vendor_id
LEFT JOIN relation ON relation.internal_vendor_id = v.vendor_id
LEFT JOIN communication ON communication.internal_vendor_id = v.vendor_id
LEFT JOIN approval ON approval.internal_vendor_id = v.vendor_id
LEFT JOIN subsidiary ON subsidiary.internal_vendor_id = v.vendor_id
WHERE companyname IS NOT NULL
