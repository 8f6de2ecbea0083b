-- The transactions among the events, up to five seconds out of order.
CREATE OR REPLACE TEMPORARY VIEW ${balance.source.view} AS
SELECT account_id, amount_transferred, ts
FROM (SELECT CAST(user_id AS STRING) AS account_id, value AS amount_transferred, timestamp_millis(unix_millis(CAST(ts AS TIMESTAMP))) AS ts
      FROM STREAM(${balance.source.table})
      WHERE event_type <> 'error')
WATERMARK ts DELAY OF INTERVAL 5 SECONDS;
