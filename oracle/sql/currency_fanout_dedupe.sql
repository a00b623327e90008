-- J05: distinct order fields by currency, distinct vendor fields by currency, joined, then distinct.
WITH recent AS (
  SELECT * FROM transactions
  WHERE transaction_type = 'Purchase Order' AND n_850_last_execution_timestamp >= TIMESTAMP '2001-02-13 12:00:00'
), ordered AS (
  SELECT DISTINCT
    recent.currency_id, tranid, CAST(original_ship_date AS DATE) AS original_ship_date,
    CAST(original_cancel_date AS DATE) AS original_cancel_date, tranid AS Carrier_Shipping_Data,
    if(sent_to_chr = 'T', 'Yes', 'No') AS sent_to_chr,
    strftime(n_860_last_execution_timestamp, '%m-%d-%Y') AS n_860_last_execution_timestamp,
    CAST(location_code AS BIGINT) AS location_code,
    i.list_item_name AS integration_status_id,
    (SELECT list_item_name FROM ready_for_860_transmit AS r WHERE r.list_id = i.list_id) AS ready_for_860_transmit_id,
    strftime(n_850_last_execution_timestamp, '%m-%d-%Y') AS n_850_last_execution_timestamp,
    strftime(acknowledgment_date, '%m-%d-%Y') AS acknowledgment_date, acknowledgment_terms,
    recent.acknowledgment_scheduled_date, recent.acknowledgment_memo,
    (SELECT list_item_name FROM acknowledgment_types AS a WHERE a.list_id = item.list_id) AS acknowledgment_type_id,
    item.list_item_name AS acknowledgment_item_status, l.acknowledgment_rate,
    l.acknowledgment_scheduled_date AS acknowledgment_scheduled_date1, l.acknowledgment_scheduled_quan,
    recent.acknowledgment_memo AS acknowledgment_memo1, l.n_2nd_acknowledgment_item_s_id AS n2nd_Acknowledgment_Item_Status,
    l.n_2nd_acknowledgment_scheduled AS n_2nd_acknowledgment_scheduled_date,
    l.n_2nd_acknowledgment_schedul_0 AS n_2nd_acknowledgment_scheduled_quantity, l.asn_record,
    l.asn_quantity_shipped, l.asn_shipment_date, l.asn_estimated_delivery_date
  FROM recent
  LEFT JOIN transaction_lines AS l USING (transaction_id)
  LEFT JOIN acknowledgment_item_statuses AS item ON item.list_id = l.acknowledgment_item_status_id
  LEFT JOIN integrationstatuses AS i ON i.list_id = recent.integration_status_id
), code AS (SELECT map(list(list_id), list(list_item_name)) AS m FROM edi_document_type_status),
partner AS (
  SELECT DISTINCT currency_id, 'Yes' AS edi, m[edi_810_id] AS edi_810, m[edi_846_id] AS edi_846, m[edi_850_id] AS edi_850,
    m[edi_855_id] AS edi_855, strftime(edi_855_activation_date, '%m-%d-%Y') AS edi_855_activation_date,
    m[edi_856_id] AS edi_856, m[edi_860_id] AS edi_860, if(edi_capable = 'T', 'Yes', 'No') AS edi_capable
  FROM vendors, code WHERE edi = 'T'
)
SELECT DISTINCT * EXCLUDE (currency_id) FROM ordered JOIN partner USING (currency_id)
