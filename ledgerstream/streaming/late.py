"""Rows that come too late for their window, kept beside the windows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ledgerstream.functions import eventtime

ACCEPTED, LATE, _BATCH = "accepted", "late", "batch_id"


def cut_off(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in epoch milliseconds, that a micro-batch runs under: what its query has written down for it.

    It is in the query's log before the batch starts, so a batch that runs again after a failure has the same one.
    """
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}", wholetext=True).first()[0].split("\n")
    return int(json.loads(lines[1])["batchWatermarkMs"])


def window_end(window: str) -> Column:
    """End of the row's window in epoch milliseconds; null for a row without time."""
    # Rows without time would not pass ``window`` itself.
    end = F.window(F.coalesce("ts", F.timestamp_millis(F.lit(0))), window)["end"]
    return F.when(F.col("ts").isNotNull(), F.unix_millis(end))


def split_batch(path: str, checkpoint: str, window: str) -> Callable[[DataFrame, int], None]:
    """Batch function: rows whose window still takes them, and rows whose window is closed, each in their own folder.

    A batch that runs again replaces both of its folders.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        closed = window_end(window) <= cut_off(spark, checkpoint, batch_id)
        marked = batch.withColumn("closed", F.coalesce(closed, F.lit(False)))
        marked.persist()  # both folders come from one reading of the batch
        try:
            for folder, rows in ((ACCEPTED, marked.filter("not closed")), (LATE, marked.filter("closed"))):
                rows.drop("closed", "ts").write.mode("overwrite").parquet(f"{path}/{folder}/{_BATCH}={batch_id}")
        finally:
            marked.unpersist()
    return write


def split(transactions: DataFrame, path: str, checkpoint: str, window: str, delay: str) -> DataStreamWriter:
    """Sorts a stream of transactions into those in time for their window and those too late for it.

    The query must be started with this ``checkpoint``. Its watermark trails the latest event time by ``delay``, as
    it would in the windowed query itself, so ``accepted`` holds what that query counts and ``late`` what it drops.
    """
    timed = eventtime.bounded(transactions.withColumn("ts", eventtime.from_millis()), delay)
    return timed.writeStream.outputMode("append").foreachBatch(split_batch(path, checkpoint, window))


def _read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])).parquet(folder)


def accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows in time, with the batch that met them; windows over them need no watermark any more."""
    return _read(spark, f"{path}/{ACCEPTED}", schema)


def late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows too late for their windows, with the batch that met them."""
    return _read(spark, f"{path}/{LATE}", schema)
