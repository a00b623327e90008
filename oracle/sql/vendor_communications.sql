-- J06 communications tab, one row per element: messages with author and first recipient.
SELECT v.name, v.vendor_id AS internal_vendor_id, m.date_0 AS date, m.author_id, (SELECT full_name FROM employees WHERE employee_id = m.author_id) AS author, m.recipient_id,
       coalesce((SELECT full_name FROM employees WHERE employee_id = m.recipient_id), m.to_0) AS primary_recipient, m.subject, m.to_0, m.from_0, m.message_type_id, m.message
FROM vendors AS v LEFT JOIN message AS m ON m.company_id = v.vendor_id
WHERE companyname IS NOT NULL
