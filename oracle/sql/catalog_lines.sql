-- The rows of J14, once for each way to name the tables.
SELECT x.*, name_parts FROM ({{q:edi_line_extract}}) AS x, (VALUES (2), (3)) AS v(name_parts)
