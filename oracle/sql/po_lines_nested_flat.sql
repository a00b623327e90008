-- J08 per PO: array size and PO totals (window totals, max per PO).
SELECT po_number, count(*) AS n_lines, max(total_on_order_quantity) AS total_on_order_quantity,
       max(total_on_order_cost) AS total_on_order_cost, max(expected_arrival_eta_line) AS expected_arrival_date,
       round(max(total_amount_lines), 2) AS total_amount_lines
FROM (
{{q:po_line_groups}}
) g
GROUP BY po_number
