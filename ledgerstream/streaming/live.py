"""The event router with schemas that become known while it runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerstream.operators import router
from ledgerstream.operators.envelope import Writer
from ledgerstream.streaming import replay

SCHEMAS = "id int, record string, avro string"
PARKED, ROUTED, REPLAYED, _BATCH = "parked", "routed", "replayed", "batch_id"
MESSAGE = "topic string, value binary, headers array<struct<key: string, value: binary>>, batch_id long"


def known_writers(spark: SparkSession, schemas: str) -> dict[int, Writer]:
    """The schema table as it is now. An id never changes its schema, so copies of a row are one; it has a row for
    each registered schema, as a registry's list has, and not for messages."""
    rows = spark.read.schema(SCHEMAS).parquet(schemas).distinct().collect()
    return {r.id: Writer(r.record, r.avro or "") for r in rows}


def _undecided(reason: str = "unknown_schema"):
    return F.coalesce(F.col("headers")[0]["value"] == F.lit(reason).cast("binary"), F.lit(False))


def route_batch(schemas: str, path: str, outputs: router.Outputs, codec: str = "avro",
                reader: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function of ``route``."""
    everything = replace(outputs, dead_letter_topic=outputs.dead_letter_topic or "dropped")
    seen: set[int] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, writers = batch.sparkSession, known_writers(batch.sparkSession, schemas)
        routed = router.route_messages(batch, writers, everything, codec, reader=reader)
        placed = routed.withColumn("topic", F.when(_undecided(), PARKED).otherwise(F.col("topic")))
        if not outputs.dead_letter_topic:
            placed = placed.filter(F.col("topic") != "dropped")
        placed.write.mode("overwrite").parquet(f"{path}/{ROUTED}/{_BATCH}={batch_id}")
        if writers.keys() - seen:  # also in the first batch after a restart
            letters = spark.read.schema(MESSAGE).parquet(f"{path}/{ROUTED}").filter(F.col("topic") == PARKED)
            replay.replay(spark, path, letters, writers, outputs, f"{path}/{REPLAYED}", codec, reader)
            seen.update(writers)

    return write


def route(messages: DataFrame, schemas: str, path: str, outputs: router.Outputs, codec: str = "avro",
          reader: str | None = None) -> DataStreamWriter:
    """Routes a stream of messages, with the schema table ``schemas`` (id, record, avro) read anew for every batch.

    A batch is decoded by a plan made for the schemas known then. Messages of other ids are parked with their bytes, and
    sent by the first batch that knows their id. A batch that runs again replaces what it wrote, and parked messages are
    replayed once each. A message that was parked comes after those that were not.
    """
    return messages.writeStream.outputMode("append").foreachBatch(route_batch(schemas, path, outputs, codec, reader))


def sent(spark: SparkSession, path: str) -> DataFrame:
    """``topic`` and ``value`` of all messages that were sent, straight or from the parked ones."""
    straight = spark.read.schema(MESSAGE).parquet(f"{path}/{ROUTED}").filter(F.col("topic") != PARKED)
    return straight.select("topic", "value").unionByName(replay.replayed_messages(spark, f"{path}/{REPLAYED}"))


def parked(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``letter_id`` and number of the messages that still wait for their schema."""
    letters = spark.read.schema(MESSAGE).parquet(f"{path}/{ROUTED}").filter(F.col("topic") == PARKED)
    return replay.waiting(letters, replay.ledger(spark, path))
