"""The event router from bytes to bytes: one topic of mixed events in, one topic per type out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerstream import schemas
from ledgerstream.operators import envelope, routing
from ledgerstream.operators.envelope import Writer


@dataclass(frozen=True)
class Outputs:
    """Topic and schema id of each output; without a dead-letter topic bad messages are dropped."""

    transaction_id: int
    fraud_report_id: int
    transaction_topic: str = routing.TRANSACTION_TOPIC
    fraud_report_topic: str = routing.FRAUD_REPORT_TOPIC
    dead_letter_topic: str | None = None


def route_messages(messages: DataFrame, writers: Mapping[int, Writer], outputs: Outputs, codec: str = "avro",
                   namespace: str = "bank", reader: str | None = None, metrics: str | None = None) -> DataFrame:
    """``value`` in; ``topic``, ``value``, ``headers`` out, in one pass without a shuffle.

    Outputs are written by the schemas that ``writers`` has under their ids. A dead letter keeps its original bytes and carries its reason as a header.
    """
    decoded = envelope.decode(messages, writers, "BankEvent", codec, reader, metrics)
    reason = F.coalesce("decode_error", routing.reject_reason())
    routed = routing.count_by_topic(routing.classify(decoded, reason))

    def encode(member: str, record: str, schema_id: int):
        struct = schemas.RECORDS[record]
        text = envelope.writer_text(writers, schema_id, record, struct, namespace)
        return envelope.encode(F.col(member), struct, schema_id, codec, text)

    topic = F.col("topic")
    headers = F.array(F.struct(F.lit("reason").alias("key"), F.col("reject_reason").cast("binary").alias("value")))
    kept = routed if outputs.dead_letter_topic else routed.filter("reject_reason is null")
    return kept.select(
        F.when(topic == routing.TRANSACTION_TOPIC, outputs.transaction_topic)
        .when(topic == routing.FRAUD_REPORT_TOPIC, outputs.fraud_report_topic)
        .otherwise(outputs.dead_letter_topic).alias("topic"),
        F.when(topic == routing.TRANSACTION_TOPIC, encode("body.member0", "Transaction", outputs.transaction_id))
        .when(topic == routing.FRAUD_REPORT_TOPIC, encode("body.member1", "FraudReport", outputs.fraud_report_id))
        .otherwise(F.col("value")).alias("value"),
        F.when(topic == routing.REJECT_TOPIC, headers).alias("headers"))
