-- J06 approvals tab, one row per element.
SELECT v.name, v.vendor_id AS internal_vendor_id, v.date_created AS date_created,
       (SELECT full_name FROM employees WHERE employee_id = v.created_by_ven_id) AS created_by,
       (SELECT list_item_name FROM finance_status WHERE list_id = v.finance_status_ven_id) AS finance_status,
       (SELECT list_item_name FROM operations_status WHERE list_id = v.operations_status_ven_id) AS operations_status
FROM vendors AS v WHERE companyname IS NOT NULL
