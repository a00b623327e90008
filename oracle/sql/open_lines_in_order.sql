-- The place of each row in the table's declared order.
SELECT po_number, line_id, dense_rank() OVER (ORDER BY po_number ASC NULLS FIRST) AS place FROM ({{q:open_in_transit_lines}}) AS x
