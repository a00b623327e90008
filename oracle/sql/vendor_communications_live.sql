-- J10 communications tab, one row per element: messages with author and first recipient.
SELECT v.name, v.vendor_id AS internal_vendor_id, m.date_0 AS date, m.author_id, (SELECT full_name FROM entity WHERE entity_id = m.author_id) AS author, m.recipient_id,
       coalesce((SELECT full_name FROM employees WHERE employee_id = m.recipient_id), m.to_0) AS primary_recipient, m.subject, m.to_0, m.from_0, m.message_type_id
FROM vendors AS v JOIN message AS m ON m.company_id = v.vendor_id AND NOT m._fivetran_deleted
WHERE companyname IS NOT NULL AND NOT v._fivetran_deleted
  AND EXISTS (SELECT 1 FROM employees AS p WHERE p.employee_id = v.created_by_ven_id AND NOT p._fivetran_deleted)
  AND EXISTS (SELECT 1 FROM entity AS w WHERE w.entity_id = m.author_id AND NOT w._fivetran_deleted)
  AND EXISTS (SELECT 1 FROM employees AS r WHERE r.employee_id = m.recipient_id AND NOT r._fivetran_deleted)
