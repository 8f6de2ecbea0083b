-- Everything an account has moved, and when it last did.
INSERT OVERWRITE ${balance.sink.table}
SELECT account_id, SUM(amount_transferred) AS total_balance, CAST(MAX(ts) AS TIMESTAMP_NTZ) AS last_updated
FROM transactions
GROUP BY account_id;
