"""Several sinks of one stream as one step."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

Sink = Callable[[DataFrame, int], None]


def _marker(spark: SparkSession, path: str):
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), marker


def in_turn(ledger: str, sinks: Mapping[str, Sink]) -> Sink:
    """Batch function that hands a batch to each sink, in the order given, and notes in ``ledger`` which are done.

    A batch that runs again after a death between two sinks skips the ones that are done, so none gets it twice; the
    sink that it died in runs again and must replace what it wrote. Every sink sees the same rows: the batch is held
    while they run. Batches are noted per query, so another query may use the same folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        batch.persist()
        try:
            for name, sink in sinks.items():
                fs, done = _marker(spark, f"{ledger}/query={query}/batch_id={batch_id}/{name}")
                if not fs.exists(done):
                    sink(batch, batch_id)
                    fs.mkdirs(done)
        finally:
            batch.unpersist()
    return write


def write_in_turn(rows: DataFrame, ledger: str, sinks: Mapping[str, Sink], mode: str = "append") -> DataStreamWriter:
    """A stream into several sinks, each batch once into each."""
    return rows.writeStream.outputMode(mode).foreachBatch(in_turn(ledger, sinks))


def files(path: str) -> Sink:
    """A sink of Parquet files, a folder to a batch, that can run a batch again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write
