"""The jobs: event router, fraud alerts, running balances. Settings come as a dict of properties."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerstream.functions.rules import AlertRules
from ledgerstream.operators import alerts, balances, envelope, router
from ledgerstream.operators.envelope import Writer
from ledgerstream.session import configure, shared_dir
from ledgerstream.sources import kafka

Properties = Mapping[str, str]
# The id of an output's schema, or the registry's ids by subject.
SchemaIds = int | Mapping[str, int]

# Default settings of the jobs.
DEFAULTS = {
    "kafka.bootstrap.servers": "localhost:9092",
    "kafka.input.topic": "bank-event",
    "kafka.transaction.topic": "transactions",
    "kafka.fraud-report.topic": "fraud-reports",
    "kafka.output.topic": "alerts",
    "kafka.consumer.group.id": "fraud-detection-consumer",
    "checkpoint.interval.ms": "60000",
    "window.size.minutes": "5",
    "watermark.max.out.of.orderness.seconds": "10",
    "fraud.threshold.transaction.count": "10",
    "fraud.threshold.total.amount": "10000.0",
    "balance.source.topic": "transactions",
    "balance.sink.topic": "account-balances",
    "balance.consumer.group.id": "balance-aggregation-v1",
}
# Our own: messages of one micro-batch, so that the first batch of a job is not the whole topic.
LIMITS = {
    "kafka.max.offsets.per.trigger": "5000000",
}


def settings(properties: Properties) -> dict[str, str]:
    return DEFAULTS | LIMITS | dict(properties)


def _folder(name: str) -> str:
    return name.replace(" ", "-")


def start(writer: DataStreamWriter, spark: SparkSession, name: str, checkpoint: str | None = None,
          interval_ms: int = 60_000, available_now: bool = False) -> StreamingQuery:
    """Start a query whose progress is kept in ``checkpoint``, by default a folder of its name under the
    shared one. Every micro-batch is a checkpoint; ``available_now`` works off what is there and stops.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{interval_ms} milliseconds"}
    location = checkpoint or f"{shared_dir(spark)}/checkpoints/{_folder(name)}"
    return writer.queryName(name).option("checkpointLocation", location).trigger(**trigger).start()


def rules(properties: Properties) -> AlertRules:
    p = settings(properties)
    return AlertRules(max_count=int(p["fraud.threshold.transaction.count"]),
                      max_amount=float(p["fraud.threshold.total.amount"]))


def fraud_alerts(transactions: DataFrame, properties: Properties) -> DataFrame:
    """Alerts with window, lateness and thresholds from the settings."""
    p = settings(properties)
    return alerts.alerts(transactions, f"{p['window.size.minutes']} minutes", rules(p),
                         f"{p['watermark.max.out.of.orderness.seconds']} seconds")


def _launch(writer: DataStreamWriter, spark: SparkSession, name: str, p: Properties) -> StreamingQuery:
    """``checkpoint.dir`` is the root of all jobs' checkpoints; each has a folder of its name there."""
    root = p.get("checkpoint.dir")
    own = f"{root.rstrip('/')}/{_folder(name)}" if root else None
    return start(writer, spark, name, own, int(p["checkpoint.interval.ms"]))


def _read(spark: SparkSession, p: Properties, topic: str, group: str) -> DataFrame:
    """A topic's messages; the two limits size a micro-batch and its tasks."""
    limits = [int(p[key]) if key in p else None for key in ("kafka.max.offsets.per.trigger", "kafka.min.partitions")]
    return kafka.read_stream(spark, p["kafka.bootstrap.servers"], topic, group, "earliest", *limits)


def _id(ids: SchemaIds, topic: str, part: str = "value") -> int:
    return ids if isinstance(ids, int) else ids[envelope.subject(topic, part)]


def start_event_router(spark: SparkSession, properties: Properties, writers: Mapping[int, Writer],
                       transaction_id: SchemaIds, fraud_report_id: SchemaIds, codec: str = "avro",
                       reader: str | None = None) -> StreamingQuery:
    """Mixed events from one topic to one topic per type, by a single query."""
    p = settings(properties)
    transaction_id = _id(transaction_id, p["kafka.transaction.topic"])
    fraud_report_id = _id(fraud_report_id, p["kafka.fraud-report.topic"])
    configure(spark)
    messages = _read(spark, p, p["kafka.input.topic"], p["kafka.consumer.group.id"])
    outputs = router.Outputs(transaction_id, fraud_report_id, p["kafka.transaction.topic"],
                             p["kafka.fraud-report.topic"], p.get("kafka.dead-letter.topic"))
    routed = router.route_messages(messages, writers, outputs, codec, reader=reader,
                                   metrics=f"decode {p['kafka.input.topic']}")
    return _launch(kafka.write_stream(routed, p["kafka.bootstrap.servers"]), spark, "Bank Event Router", p)


def topic_transactions(spark: SparkSession, properties: Properties, writers: Mapping[int, Writer],
                       topic_key: str = "balance.source.topic", group_key: str = "balance.consumer.group.id",
                       codec: str = "avro", reader: str | None = None) -> DataFrame:
    """Transactions from the topic the settings name; register it as a view to use it in a SQL job."""
    p = settings(properties)
    messages = _read(spark, p, p[topic_key], p[group_key])
    return envelope.records(envelope.decode(messages, writers, "Transaction", codec, reader,
                                            metrics=f"decode {p[topic_key]}"))


def topic_balances(changes: DataFrame, properties: Properties, key_id: SchemaIds, value_id: SchemaIds,
                   codec: str = "avro", writers: Mapping[int, Writer] | None = None) -> DataStreamWriter:
    """Writer of balances to the compacted topic the settings name, keyed by account."""
    p = settings(properties)
    topic = p["balance.sink.topic"]
    out = envelope.balance_messages(changes, _id(key_id, topic, "key"), _id(value_id, topic), codec, writers=writers)
    return kafka.write_stream(out, p["kafka.bootstrap.servers"], p["balance.sink.topic"], mode="update")


def start_fraud_alerts(spark: SparkSession, properties: Properties, writers: Mapping[int, Writer],
                       alert_id: SchemaIds, codec: str = "avro", reader: str | None = None) -> StreamingQuery:
    """Routed transactions to alerts."""
    p = settings(properties)
    configure(spark)
    transactions = topic_transactions(spark, p, writers, "kafka.transaction.topic", "kafka.consumer.group.id",
                                      codec, reader)
    out = envelope.messages(fraud_alerts(transactions, p), "Alert", _id(alert_id, p["kafka.output.topic"]), codec, writers=writers)
    writer = kafka.write_stream(out, p["kafka.bootstrap.servers"], p["kafka.output.topic"])
    return _launch(writer, spark, "Fraud Alerts", p)


def start_account_balances(spark: SparkSession, properties: Properties, writers: Mapping[int, Writer],
                           key_id: SchemaIds, value_id: SchemaIds, codec: str = "avro",
                           reader: str | None = None) -> StreamingQuery:
    """Routed transactions to a compacted topic of balances keyed by account."""
    p = settings(properties)
    configure(spark)
    transactions = topic_transactions(spark, p, writers, codec=codec, reader=reader)
    writer = topic_balances(balances.account_balances(transactions), p, key_id, value_id, codec, writers)
    return _launch(writer, spark, "Account Balances", p)
