-- The events table, read as a stream of files.
CREATE TABLE ${balance.source.table} (
    event_id BIGINT,
    ts TIMESTAMP_NTZ,
    user_id BIGINT,
    event_type STRING,
    value DOUBLE,
    props STRING
) USING ${balance.source.format}
OPTIONS (maxFilesPerTrigger '${balance.source.files.per.batch}')
LOCATION '${balance.source.path}';
