-- The place of each row in the table's declared order.
SELECT tranid, original_cancel_date, edi_855, dense_rank() OVER (ORDER BY original_cancel_date ASC NULLS FIRST, edi_855 DESC NULLS LAST) AS place FROM ({{q:currency_fanout_dedupe}}) AS x
