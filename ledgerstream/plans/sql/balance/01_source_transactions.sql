-- Transactions with their event time.
CREATE OR REPLACE TEMPORARY VIEW transactions AS
SELECT *, timestamp_millis(timestamp) AS ts
FROM ${balance.source.view};
