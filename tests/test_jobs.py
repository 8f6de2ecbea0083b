"""The three jobs as wired by their settings, with folders in the place of topics."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import MINUTE, rows
from ledgerstream.operators import envelope
from ledgerstream.operators.envelope import Writer
from ledgerstream.plans import sqljobs
from ledgerstream.sources import kafka
from ledgerstream.streaming import jobs

WRITERS = {1: Writer("BankEvent"), 2: Writer("Transaction"), 3: Writer("FraudReport"), 4: Writer("Alert")}


@pytest.fixture
def topics(monkeypatch, tmp_path):
    def read(spark, servers, topic, group, offsets, *limits):
        return spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{topic}")

    def write(sent, servers, topic=None, mode="append"):
        kafka.sink_options(servers, topic)

        def append(batch, _):
            named = batch.withColumn("to", F.lit(topic) if topic else F.col("topic"))
            named.write.mode("append").partitionBy("to").parquet(f"{tmp_path}/sent")
        return sent.writeStream.outputMode(mode).foreachBatch(append)

    monkeypatch.setattr(kafka, "read_stream", read)
    monkeypatch.setattr(kafka, "write_stream", write)
    return tmp_path


def run(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def sent(spark, topics, topic):
    return spark.read.parquet(f"{topics}/sent").filter(F.col("to") == topic)


def settings(topics, **properties):
    return {"checkpoint.interval.ms": "50", "checkpoint.dir": f"{topics}/checkpoint", **properties}


def publish(messages, topics, topic):
    messages.coalesce(1).write.mode("append").parquet(f"{topics}/{topic}")


def test_event_router(spark, transactions, topics):
    body = transactions([("a", 1.5, 10), ("b", 2, 20)])
    wrapped = body.select(F.struct(F.lit("Transaction").alias("event_type")).alias("metadata"),
                          F.struct(F.struct("*").alias("member0")).alias("body"))
    publish(wrapped.select(envelope.frames.frame(1, F.to_json(F.struct("*")).cast("binary")).alias("value")),
            topics, "bank-event")
    publish(spark.createDataFrame([(bytearray(b"junk"),)], "value binary"), topics, "bank-event")
    run(jobs.start_event_router(spark, settings(topics, **{"kafka.transaction.topic": "mine",
                                                           "kafka.dead-letter.topic": "dead"}), WRITERS, 2, 3, "json"))
    read = envelope.records(envelope.decode(sent(spark, topics, "mine"), WRITERS, "Transaction", "json"))
    assert rows(read) == rows(body)
    assert [bytes(r.value) for r in sent(spark, topics, "dead").collect()] == [b"junk"]


def test_fraud_alerts(spark, transactions, topics):
    for minute in (0, 30, 60):
        data = transactions([("a", 100, minute * MINUTE + i) for i in range(11 if minute == 0 else 1)])
        publish(envelope.messages(data, "Transaction", 2, "json"), topics, "transactions")
    run(jobs.start_fraud_alerts(spark, settings(topics), WRITERS, 4, "json"))
    read = envelope.records(envelope.decode(sent(spark, topics, "alerts"), WRITERS, "Alert", "json"))
    assert rows(read) == [("a", 1, "MEDIUM: High frequency (11 transactions)", 2, 0, 5 * MINUTE, 11, 1100.0)]


def test_account_balances(spark, transactions, topics):
    for amount in (1, 2, 4):
        publish(envelope.messages(transactions([("a", amount, amount)]), "Transaction", 2, "json"), topics, "transactions")
    run(jobs.start_account_balances(spark, settings(topics), WRITERS, 8, 9, "json"))
    totals = [json.loads(bytes(r.value[5:]))["total_balance"] for r in sent(spark, topics, "account-balances").collect()]
    assert sorted(totals) == [1.0, 3.0, 7.0]


def test_balances_as_a_sql_job_on_topics(spark, transactions, topics):
    for amount in (1, 2, 4):
        publish(envelope.messages(transactions([("a", amount, amount)]), "Transaction", 2, "json"), topics, "transactions")
    p = settings(topics, **{"sql.files": "balance_stream/04_logic_aggregation.sql", "balance.sink.table": "topic",
                            "balance.source.view": "topic_transactions"})
    timed = jobs.topic_transactions(spark, p, WRITERS, codec="json").withColumn("ts", F.timestamp_millis("timestamp"))
    timed.createOrReplaceTempView("topic_transactions")
    query = sqljobs.start(spark, p, lambda changes: jobs.topic_balances(changes, p, 8, 9, "json"),
                          checkpoint=p["checkpoint.dir"], available_now=True)
    query.awaitTermination()
    totals = [json.loads(bytes(r.value[5:]))["total_balance"] for r in sent(spark, topics, "account-balances").collect()]
    assert sorted(totals) == [1.0, 3.0, 7.0]


def test_jobs_of_one_dict_have_checkpoints_of_their_own(spark, transactions, topics):
    """``checkpoint.dir`` is a root: the second job reads everything too."""
    publish(envelope.messages(transactions([("a", 20000, 1)]), "Transaction", 2, "json"), topics, "transactions")
    publish(envelope.messages(transactions([("b", 1, 10 * MINUTE)]), "Transaction", 2, "json"), topics, "transactions")
    publish(envelope.messages(transactions([("b", 1, 20 * MINUTE)]), "Transaction", 2, "json"), topics, "transactions")
    p = settings(topics)
    subjects = {"account-balances-key": 8, "account-balances-value": 9, "alerts-value": 4}
    run(jobs.start_account_balances(spark, p, WRITERS, subjects, subjects, "json"))
    run(jobs.start_fraud_alerts(spark, p, WRITERS, subjects, "json"))
    assert {bytes(r.key[:5])[-1] for r in sent(spark, topics, "account-balances").collect()} == {8}
    assert sent(spark, topics, "account-balances").count() == 3 and sent(spark, topics, "alerts").count() == 1


def test_micro_batches_are_limited_by_default(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(kafka, "read_stream", lambda *a: asked.append(a) or spark.readStream.format("rate").load().selectExpr("cast(null as binary) value"))
    jobs.topic_transactions(spark, {}, WRITERS, codec="json")
    jobs.topic_transactions(spark, {"kafka.max.offsets.per.trigger": "7", "kafka.min.partitions": "3"}, WRITERS, codec="json")
    assert [a[-2:] for a in asked] == [(5_000_000, None), (7, 3)]
