-- One row per account; a micro-batch upserts the accounts it changed.
CREATE TABLE ${balance.sink.table} (
    account_id STRING,
    total_balance DOUBLE,
    last_updated TIMESTAMP_NTZ
) USING parquet
LOCATION '${balance.sink.path}'
TBLPROPERTIES ('sink' = 'upsert', 'sink.keys' = 'account_id');
