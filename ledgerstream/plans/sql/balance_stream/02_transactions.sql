-- Streamed transactions with their event time, up to five seconds out of order.
CREATE OR REPLACE TEMPORARY VIEW ${balance.source.view} AS
SELECT *
FROM (SELECT *, timestamp_millis(timestamp) AS ts FROM STREAM(${balance.source.table}))
WATERMARK ts DELAY OF INTERVAL 5 SECONDS;
