-- One row per account.
CREATE TABLE ${balance.sink.table} (
    account_id STRING,
    total_balance DOUBLE,
    last_updated TIMESTAMP_NTZ
) USING parquet
LOCATION '${balance.sink.path}';
