-- J10 approvals tab, one row per element.
SELECT v.name, v.vendor_id AS internal_vendor_id, strftime(v.date_created, '%m-%d-%Y %H:%M:%S') AS date_created,
       (SELECT full_name FROM employees WHERE employee_id = v.created_by_ven_id) AS created_by,
       (SELECT list_item_name FROM finance_status WHERE list_id = v.finance_status_ven_id) AS finance_status,
       (SELECT list_item_name FROM operations_status WHERE list_id = v.operations_status_ven_id) AS operations_status
FROM vendors AS v WHERE companyname IS NOT NULL AND NOT v._fivetran_deleted
  AND EXISTS (SELECT 1 FROM employees AS p WHERE p.employee_id = v.created_by_ven_id AND NOT p._fivetran_deleted)
  AND EXISTS (SELECT 1 FROM finance_status AS f WHERE f.list_id = v.finance_status_ven_id AND NOT f._fivetran_deleted)
  AND EXISTS (SELECT 1 FROM operations_status AS o WHERE o.list_id = v.operations_status_ven_id AND NOT o._fivetran_deleted)
