-- J06 subsidiaries tab, one row per element: the map rows beside the primary subsidiary.
SELECT v.name, v.vendor_id AS internal_vendor_id, s.name AS primary_subsidiary, s.name AS subsidiary,
       coalesce(m.subsidiary_id = v.subsidiary, false) AS "primary", s.isinactive, abs(m.balance) AS balance, abs(m.balance_base) AS balance_base,
       abs(m.unbilled_orders) AS unbilled_orders, abs(m.unbilled_orders_base) AS unbilled_orders_base, m.credit_limit, m.subsidiary_id,
       u.name AS currency, s.state_tax_number AS tax_code
FROM vendors AS v
LEFT JOIN subsidiaries AS s ON s.subsidiary_id = v.subsidiary
LEFT JOIN currencies AS u ON u.currency_id = v.currency_id
LEFT JOIN vendor_subsidiary_map AS m ON m.vendor_id = v.vendor_id
WHERE companyname IS NOT NULL
