"""Files as record streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


PER_BATCH = 1000  # files of one micro-batch; all files are read, in as many batches as that takes


def read_batch(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(format).load(path)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet",
                files_per_batch: int | None = PER_BATCH) -> DataFrame:
    """Files of a folder or glob, oldest first; ``files_per_batch`` bounds a micro-batch (None: no bound)."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
