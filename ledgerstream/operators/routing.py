"""Split an envelope stream by event type, keeping what cannot be routed with its reason."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstream import schemas

TRANSACTION_TOPIC = "transactions"
FRAUD_REPORT_TOPIC = "fraud-reports"
REJECT_TOPIC = "rejects"

_TYPE = "metadata.event_type"
# Discriminator -> the body member that must be present, and no other.
_MEMBERS = dict(zip(schemas.EVENT_TYPES, ("body.member0", "body.member1")))


def _is(event_type: str) -> Column:
    # A plain conjunction, so that it reaches the scan where the envelope is stored in Parquet.
    own = (F.col(_TYPE) == event_type) & F.col(_MEMBERS[event_type]).isNotNull()
    return reduce(and_, (F.col(m).isNull() for t, m in _MEMBERS.items() if t != event_type), own)


def transactions(events: DataFrame) -> DataFrame:
    return events.filter(_is("Transaction")).select("body.member0.*")


def fraud_reports(events: DataFrame) -> DataFrame:
    return events.filter(_is("FraudReport")).select("body.member1.*")


def reject_reason() -> Column:
    """Why an event cannot be routed, or null."""
    known = F.coalesce(F.col(_TYPE).isin(*schemas.EVENT_TYPES), F.lit(False))
    return (F.when(F.col("metadata").isNull(), "null_metadata")
            .when(~known, "unknown_type")
            .when(~F.coalesce(_is("Transaction") | _is("FraudReport"), F.lit(False)), "body_mismatch"))


def classify(events: DataFrame, reason: Column | None = None) -> DataFrame:
    """Add ``topic`` and ``reject_reason`` to every event, in one narrow step.

    ``reason`` replaces the router's own grounds for a reject.
    """
    topic = (F.when(F.col("reject_reason").isNotNull(), REJECT_TOPIC)
             .when(F.col(_TYPE) == "Transaction", TRANSACTION_TOPIC)
             .otherwise(FRAUD_REPORT_TOPIC))
    reason = reject_reason() if reason is None else reason
    return events.withColumn("reject_reason", reason).withColumn("topic", topic)


def rejects(events: DataFrame) -> DataFrame:
    return events.withColumn("reject_reason", reject_reason()).filter("reject_reason is not null")


def count_by_topic(classified: DataFrame, name: str = "routing") -> DataFrame:
    """Report rows per outcome as metrics of the query, without an extra pass."""
    def count(condition: Column, label: str) -> Column:
        return F.count(F.when(condition, 1)).alias(label)

    reasons = ("null_metadata", "unknown_type", "body_mismatch")
    return classified.observe(
        name,
        count(F.col("topic") == TRANSACTION_TOPIC, "transactions"),
        count(F.col("topic") == FRAUD_REPORT_TOPIC, "fraud_reports"),
        *(count(F.col("reject_reason") == reason, reason) for reason in reasons),
    )
