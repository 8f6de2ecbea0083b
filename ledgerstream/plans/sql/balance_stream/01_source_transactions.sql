-- Stored transactions, read as a stream of files.
CREATE TABLE ${balance.source.table} (
    id STRING,
    transaction_type_id INT,
    account_id STRING,
    bank_id STRING,
    amount_transferred DOUBLE,
    reason STRING,
    timestamp BIGINT
) USING ${balance.source.format}
OPTIONS (maxFilesPerTrigger '${balance.source.files.per.batch}')
LOCATION '${balance.source.path}';
