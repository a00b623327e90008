-- The place of each row in the table's declared order.
SELECT po_number, vendor, shipment_id, dense_rank() OVER (ORDER BY vendor ASC NULLS FIRST) AS place FROM ({{q:carrier_rows_dedupe}}) AS x
