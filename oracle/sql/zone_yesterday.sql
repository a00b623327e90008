-- E31: SKUs of the snapshot taken at the start of yesterday in America/Denver.
SELECT sku, count(*) AS n_rows
FROM sb_inventory
WHERE snapshot_day = ((date_trunc('day', (TIMESTAMP '2001-03-15 12:00:00' AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver')
                       AT TIME ZONE 'America/Denver') AT TIME ZONE 'UTC') - INTERVAL 24 HOUR
GROUP BY sku
