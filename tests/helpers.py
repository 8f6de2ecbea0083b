from pyspark.sql import DataFrame, SparkSession

from ledgerstream import schemas
from ledgerstream.sources import files
from ledgerstream.streaming import jobs

MINUTE = 60_000


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def write_file(df: DataFrame, folder: str) -> None:
    """One more file in a stream's folder."""
    df.coalesce(1).write.mode("append").parquet(folder)


def stream(spark: SparkSession, folder: str, schema=schemas.TRANSACTION, files_per_batch: int = 1) -> DataFrame:
    return files.read_stream(spark, folder, schema, files_per_batch=files_per_batch)


def finish(writer, spark, name: str, folder: str):
    """Run a stream over all there is; returns the finished query."""
    query = jobs.start(writer, spark, name, f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    return query
