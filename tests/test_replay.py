import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerstream import schemas
from ledgerstream.functions import frames
from ledgerstream.operators import envelope, router
from ledgerstream.operators.envelope import Writer
from ledgerstream.streaming import replay

OLD = {1: Writer("BankEvent"), 2: Writer("Transaction"), 3: Writer("FraudReport")}
NEW = OLD | {9: Writer("BankEvent")}
OUTPUTS = router.Outputs(2, 3, dead_letter_topic="dead")


@pytest.fixture
def letters(transactions):
    """Framed events under an id that is not known yet."""
    def make(items, schema_id=9, event_type="Transaction"):
        body = transactions(items).select(F.struct(F.lit(event_type).alias("event_type")).alias("metadata"),
                                          F.struct(F.struct("*").alias("member0")).alias("body"))
        return body.select(frames.frame(schema_id, F.to_json(F.struct("*")).cast("binary")).alias("value"))
    return make


def run(spark, path, found, writers):
    return replay.replay(spark, path, found, writers, OUTPUTS, f"{path}/topics", "json")


def sent(spark, path):
    messages = replay.replayed_messages(spark, f"{path}/topics")
    read = envelope.records(envelope.decode(messages.filter("topic = 'transactions'"), OLD, "Transaction", "json"))
    return rows(read, "account_id", "amount_transferred")


def test_each_letter_once(spark, letters, tmp_path):
    path, found = str(tmp_path), letters([("a", 1, 1), ("b", 2, 2)])
    run(spark, path, found, OLD)
    assert sent(spark, path) == []
    run(spark, path, found, NEW)
    once = sent(spark, path)
    run(spark, path, found, NEW)
    assert sent(spark, path) == once == [("a", 1.0), ("b", 2.0)]
    run(spark, path, found.union(letters([("c", 3, 3)])), NEW)  # a letter that has come since
    assert sent(spark, path) == [*once, ("c", 3.0)]


def test_equal_letters_count(spark, letters, tmp_path):
    path, found = str(tmp_path), letters([("a", 1, 1)])
    run(spark, path, found.union(found), NEW)
    assert sent(spark, path) == [("a", 1.0)] * 2
    run(spark, path, found.union(found).union(found), NEW)
    assert sent(spark, path) == [("a", 1.0)] * 3


def test_letters_that_cannot_be_routed_wait(spark, letters, tmp_path):
    path = str(tmp_path)
    found = letters([("a", 1, 1)]).union(letters([("b", 2, 2)], event_type="Refund")).union(letters([("c", 3, 3)], schema_id=8))
    found = found.union(spark.createDataFrame([(None,), (b"",), (b"\x00\x00\x00\x00\x09{",)], "value binary"))
    run(spark, path, found, NEW)
    assert sent(spark, path) == [("a", 1.0)]
    waiting = replay.waiting(found, replay.ledger(spark, path))
    assert sum(r.waiting for r in waiting.collect()) == 4
    run(spark, path, found, NEW | {8: Writer("BankEvent")})
    assert sent(spark, path) == [("a", 1.0), ("c", 3.0)]


def test_a_run_that_died_is_done_again(spark, letters, tmp_path, monkeypatch):
    """The messages were written, the ledger was not."""
    path, found = str(tmp_path), letters([("a", 1, 1), ("b", 2, 2)])
    monkeypatch.setattr(replay, "LEDGER_FOLDER", "nowhere/that/is/read")
    run(spark, path, found, NEW)
    monkeypatch.undo()
    assert run(spark, path, found, NEW) == 0
    assert run(spark, path, found, NEW) == 1
    assert sent(spark, path) == [("a", 1.0), ("b", 2.0)]
