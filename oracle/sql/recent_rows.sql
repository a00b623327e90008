-- F7/E28: carrier headers created in the 30 days before the run time.
SELECT carrier_shipping_data_id, carrier_shipping_data_name, date_created, is_inactive
FROM carrier_shipping_data
WHERE date_created >= TIMESTAMP '2001-03-15 12:00:00' - INTERVAL 30 DAY
