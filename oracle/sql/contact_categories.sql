-- J04: contacts x address values with their type names (NULL -> ''), flattened.
SELECT
  c.contact_id, c.full_name, c.name AS contact, c.salutation AS salutation_MR_MS,
  c.firstname || ' ' || c.lastname AS name, c.company_id, co.companyname AS company, c.title AS job_title,
  c.comments, c.is_private AS private,
  array_to_string(list_sort(list(coalesce(ct.name, ''))), '|') AS category,
  c.email, c.altemail, c.phone AS mainphone, c.officephone, c.mobilephone, c.homephone, c.fax, c.address,
  c.subsidiary AS subsidiary_id, sub.name AS subsidiary, c.last_sales_activity, sup.name AS supervisor,
  c.supervisorphone, asst.name AS assistand, c.assistantphone, ab.is_default_ship_address,
  ab.is_default_bill_address, ab.address AS address1, c.isinactive,
  count(*) AS n_category
FROM contacts c
LEFT JOIN address_book ab ON ab.entity_id = c.contact_id
LEFT JOIN subsidiaries sub ON sub.subsidiary_id = c.subsidiary
LEFT JOIN companies co ON co.company_id = c.company_id
LEFT JOIN entity sup ON sup.entity_id = c.supervisior_id
LEFT JOIN entity asst ON asst.entity_id = c.assistant_id
LEFT JOIN contact_types ct ON ct.contact_id = c.contact_id
GROUP BY c.contact_id, c.full_name, c.name, c.salutation, c.firstname || ' ' || c.lastname, c.company_id,
  co.companyname, c.title, c.comments, c.is_private, c.email, c.altemail, c.phone, c.officephone,
  c.mobilephone, c.homephone, c.fax, c.address, c.subsidiary, sub.name, c.last_sales_activity, sup.name,
  c.supervisorphone, asst.name, c.assistantphone, ab.is_default_ship_address, ab.is_default_bill_address,
  ab.address, c.isinactive
