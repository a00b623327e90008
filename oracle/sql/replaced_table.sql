-- K1: readers see the rows of the later run only.
SELECT po_number, line_id, qty_in_transit, transit_window_end, 1 AS n_versions FROM ({{q:open_in_transit_lines}}) AS x
