-- E2/E19/E20: price text as a number and as a cleaned rate text.
SELECT transaction_id, transaction_line_id, item_unit_price,
       CAST(replace(item_unit_price, '%', '') AS DOUBLE) AS price,
       regexp_replace(item_unit_price, '%|-', '', 'g') AS rate
FROM transaction_lines
