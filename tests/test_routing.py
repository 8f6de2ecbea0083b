import pytest
from pyspark.sql import functions as F

from helpers import finish, rows, stream
from ledgerstream import schemas
from ledgerstream.functions import eventtime
from ledgerstream.operators import routing
from ledgerstream.sources import bank_events
from ledgerstream.streaming import sinks

TX = ("t1", 1, "a", "b", 5.0, "memo", 1000)
FR = ("r1", "c1", "t1", "a", "b", "HIGH", 2000)
CASES = [
    (("Transaction",), (TX, None), "transactions", None),
    (("FraudReport",), (None, FR), "fraud-reports", None),
    (None, (TX, None), "rejects", "null_metadata"),
    (("Refund",), (TX, None), "rejects", "unknown_type"),
    ((None,), (TX, None), "rejects", "unknown_type"),
    (("Transaction",), (None, FR), "rejects", "body_mismatch"),
    (("FraudReport",), (TX, None), "rejects", "body_mismatch"),
    (("Transaction",), (None, None), "rejects", "body_mismatch"),
    (("Transaction",), None, "rejects", "body_mismatch"),
    (("Transaction",), (TX, FR), "rejects", "body_mismatch"),
    (("FraudReport",), (TX, FR), "rejects", "body_mismatch"),
]


@pytest.fixture
def events(spark):
    return spark.createDataFrame([c[:2] for c in CASES], schemas.BANK_EVENT)


def test_every_case(events):
    assert [tuple(r) for r in routing.classify(events).select("topic", "reject_reason").collect()] == [
        c[2:] for c in CASES]


def test_branches(events):
    assert rows(routing.transactions(events)) == [TX]
    assert rows(routing.fraud_reports(events)) == [FR]
    assert routing.rejects(events).count() == 9


def test_event_time(events):
    millis = events.select(F.unix_millis(eventtime.envelope_time()).alias("ms"), "body")
    assert millis.filter("body.member0 is not null and ms != 1000").count() == 0
    assert millis.filter("body.member0 is null and body.member1 is not null and ms != 2000").count() == 0
    wall = millis.filter("body is null or (body.member0 is null and body.member1 is null)").collect()
    assert len(wall) == 2 and all(r.ms > 1_700_000_000_000 for r in wall)


def test_nothing_is_lost(spark, sf_dir):
    events = bank_events.events(spark, sf_dir)
    envelopes = bank_events.corrupted_envelopes(events)
    parts = [f(envelopes).count() for f in (routing.transactions, routing.fraud_reports, routing.rejects)]
    assert all(parts) and sum(parts) == events.count()


def test_stored_envelope_is_filtered_and_pruned_in_the_scan(spark, events, tmp_path):
    events.write.parquet(f"{tmp_path}/events")
    plan = (routing.transactions(spark.read.parquet(f"{tmp_path}/events")).select("account_id")
            ._jdf.queryExecution().executedPlan().toString())
    assert "EqualTo(metadata.event_type,Transaction)" in plan
    assert "Exchange" not in plan


def test_stream_writes_each_topic_and_reports_counts(spark, events, tmp_path):
    events.coalesce(1).write.parquet(f"{tmp_path}/in")
    routed = routing.count_by_topic(routing.classify(stream(spark, f"{tmp_path}/in", schemas.BANK_EVENT)))
    query = finish(sinks.append_files(routed, f"{tmp_path}/out", by=["topic"]), spark, "router", str(tmp_path))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out.groupBy("topic").count()) == [("fraud-reports", 1), ("rejects", 9), ("transactions", 1)]
    assert query.recentProgress[0].observedMetrics["routing"].asDict() == {
        "transactions": 1, "fraud_reports": 1, "null_metadata": 1, "unknown_type": 2, "body_mismatch": 6}
