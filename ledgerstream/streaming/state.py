"""What a streaming query holds, read from its checkpoint while it runs or afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: number, name, partitions, and the batches that can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


def read(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator_id: int = 0) -> DataFrame:
    """``key`` and ``value`` of an operator's state after a batch, by default the last one.

    Batches that the query's retention has removed cannot be read.
    """
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def balances(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The balances that a streamed ``account_balances`` holds after a batch, without its sink."""
    held = read(spark, checkpoint, batch_id)
    total, latest = (f"value.`{f.name}`" for f in held.schema["value"].dataType.fields)
    return held.select("key.account_id", F.col(total).alias("total_balance"),
                       F.col(latest).cast("timestamp_ntz").alias("last_updated"))


def changed_keys(spark: SparkSession, checkpoint: str, after: int, upto: int, operator_id: int = 0) -> DataFrame:
    """Keys whose state differs between two batches, with the value before and after (null: no state)."""
    # Values may hold types that do not compare, so their texts are compared.
    earlier, later = (read(spark, checkpoint, b, operator_id).groupBy("key").agg(F.first("value").alias(name))
                      for b, name in ((after, "before"), (upto, "now")))
    both = earlier.join(later, "key", "full_outer")
    return both.filter(~F.to_json("before").eqNullSafe(F.to_json("now")))
