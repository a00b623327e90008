-- X5: one code list under six roles.
SELECT v.vendor_id, e810.list_item_name AS edi_810, e846.list_item_name AS edi_846, e850.list_item_name AS edi_850,
       e855.list_item_name AS edi_855, e856.list_item_name AS edi_856, e860.list_item_name AS edi_860
FROM vendors v
LEFT JOIN edi_document_type_status e810 ON e810.list_id = v.edi_810_id
LEFT JOIN edi_document_type_status e846 ON e846.list_id = v.edi_846_id
LEFT JOIN edi_document_type_status e850 ON e850.list_id = v.edi_850_id
LEFT JOIN edi_document_type_status e855 ON e855.list_id = v.edi_855_id
LEFT JOIN edi_document_type_status e856 ON e856.list_id = v.edi_856_id
LEFT JOIN edi_document_type_status e860 ON e860.list_id = v.edi_860_id
