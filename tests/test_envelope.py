import json

import pytest
from pyspark.sql import functions as F

from helpers import finish, rows, stream
from ledgerstream import schemas
from ledgerstream.functions import frames
from ledgerstream.operators import balances, envelope, router
from ledgerstream.operators.envelope import Writer
from ledgerstream.streaming import sinks

WRITERS = {1: Writer("BankEvent"), 2: Writer("Transaction"), 3: Writer("FraudReport"), 4: Writer("Transaction")}
TX = {"id": "t", "transaction_type_id": 1, "account_id": "a", "bank_id": "b", "amount_transferred": 5.5,
      "reason": "memo", "timestamp": 7}


def message(schema_id, payload, marker=b"\x00"):
    text = payload if isinstance(payload, bytes) else json.dumps(payload).encode()
    return bytearray(marker + schema_id.to_bytes(4, "big") + text)


@pytest.fixture
def values(spark):
    return lambda *items: spark.createDataFrame([(i,) for i in items], "value binary")


def test_frame_parts(spark, values):
    df = values(message(258, b"abc"), bytearray(b"\x00\x00"), bytearray(b"\x01\x00\x00\x00\x01x"), None)
    got = df.select(frames.is_framed("value"), frames.schema_id("value"), frames.payload("value")).collect()
    assert tuple(got[0]) == (True, 258, bytearray(b"abc"))
    assert [r[0] for r in got] == [True, False, False, None]
    assert [r[0] for r in df.select(frames.written_by("value", [1, 258])).collect()] == [True, False, False, None]


def test_frame_and_back(spark):
    df = spark.createDataFrame([(bytearray(b"xyz"),), (None,)], "p binary")
    framed = df.select(frames.frame(70000, F.col("p")).alias("value"))
    assert framed.first().value == bytearray(b"\x00\x00\x01\x11\x70xyz")
    assert framed.collect()[1].value is None


def test_every_kind_of_bad_message(values):
    df = values(message(2, TX), message(4, TX), None, bytearray(b""), message(2, TX, b"\x01"), message(99, TX),
                message(3, TX), message(2, b"{broken"), message(2, b""), message(2, b"[]"),
                message(2, {**TX, "timestamp": "late"}), message(2, {k: v for k, v in TX.items() if k != "bank_id"}),
                message(2, {**TX, "id": None}))
    decoded = envelope.decode(df, WRITERS, "Transaction", "json")
    assert [r.decode_error for r in decoded.collect()] == [
        None, None, "null_value", "bad_frame", "bad_frame", "unknown_schema", "wrong_record", "decode_error",
        "decode_error", "decode_error", "decode_error", "decode_error", "decode_error"]
    assert rows(envelope.records(decoded)) == [tuple(TX.values())] * 2
    assert envelope.undecodable(decoded).count() == 11


def test_needs_a_writer_of_the_record(values):
    with pytest.raises(ValueError, match="Alert"):
        envelope.decode(values(), WRITERS, "Alert", "json")


def test_payload_is_decoded_once(values):
    decoded = envelope.records(envelope.decode(values(message(2, TX)), WRITERS, "Transaction", "json"))
    assert decoded._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_round_trip(transactions):
    data = transactions([("a", 1.25, 10), ("b", -3, 20), ("a", 0, 10)])
    sent = envelope.messages(data, "Transaction", 2, "json")
    assert rows(envelope.records(envelope.decode(sent, WRITERS, "Transaction", "json"))) == rows(data)


def test_null_record_gives_null_message_and_null_field_fails(spark):
    df = spark.createDataFrame([(None,)], "r struct<account_id: string>")
    struct = df.schema["r"].dataType
    assert df.select(envelope.encode(F.col("r"), struct, 1, "json").alias("v")).first().v is None
    df = spark.createDataFrame([((None,),)], df.schema)
    with pytest.raises(Exception, match="null field"):
        df.select(envelope.encode(F.col("r"), struct, 1, "json").alias("v")).collect()


def test_balance_messages_are_keyed(transactions):
    sent = envelope.balance_messages(balances.account_balances(transactions([("a", 1, 10), ("a", 2, 5)])), 8, 9, "json")
    row = sent.first()
    assert row.key == message(8, b'{"account_id":"a"}')
    assert json.loads(bytes(row.value[5:])) == {
        "account_id": "a", "total_balance": 3.0, "last_updated": "1970-01-01T00:00:00.010"}


def bank_event(event_type, member, body):
    return {"metadata": {"event_type": event_type}, "body": {member: body}}


def test_router_from_bytes_to_bytes(spark, values, tmp_path):
    report = {"report_id": "r", "fraud_chain_id": "c", "transaction_id": "t", "account_id": "a", "bank_id": "b",
              "risk_level": "LOW", "timestamp": 9}
    broken = message(1, b"{")
    values(message(1, bank_event("Transaction", "member0", TX)), message(1, bank_event("FraudReport", "member1", report)),
           message(1, bank_event("FraudReport", "member0", TX)), broken,
           message(1, {"metadata": {"event_type": "Transaction"}, "body": {"member0": TX, "member1": report}}),
           message(1, bank_event("Transaction", "member0", {**TX, "account_id": None})),
           message(1, bank_event(None, "member0", TX))
           ).coalesce(1).write.parquet(f"{tmp_path}/in")
    outputs = router.Outputs(2, 3, "tx", "fr", "dead")
    routed = router.route_messages(stream(spark, f"{tmp_path}/in", "value binary"), WRITERS, outputs, "json", metrics="decode")
    query = finish(sinks.append_files(routed, f"{tmp_path}/out", by=["topic"]), spark, "bytes", str(tmp_path))

    out = spark.read.parquet(f"{tmp_path}/out")
    read = {record: envelope.records(envelope.decode(out.filter(F.col("topic") == topic), WRITERS, record, "json"))
            for topic, record in (("tx", "Transaction"), ("fr", "FraudReport"))}
    assert rows(read["Transaction"]) == [tuple(TX.values())]
    assert rows(read["FraudReport"]) == [tuple(report.values())]
    dead = [(bytes(r.headers[0].value).decode(), bytes(r.value)) for r in out.filter("topic = 'dead'").collect()]
    assert sorted(reason for reason, _ in dead) == ["body_mismatch"] * 2 + ["decode_error"] * 3
    assert ("decode_error", bytes(broken)) in dead
    metrics = query.recentProgress[0].observedMetrics
    assert metrics["decode"]["decode_error"] == 3 and metrics["routing"]["body_mismatch"] == 2


def test_router_without_dead_letters_drops_them(values):
    routed = router.route_messages(values(message(1, b"{"), message(1, bank_event("Transaction", "member0", TX))),
                                   WRITERS, router.Outputs(2, 3), "json")
    assert rows(routed, "topic") == [("transactions",)]


def test_avro_texts_are_valid(spark):
    parse = lambda text: spark._jvm.org.apache.avro.Schema.Parser().parse(text)
    event = parse(schemas.bank_event_avro_schema("some.bank"))
    assert event.getFullName() == "some.bank.BankEvent"
    union = event.getField("body").schema()
    assert [s.getFullName() for s in union.getTypes()] == ["some.bank.Transaction", "some.bank.FraudReport"]
    for name in ("Transaction", "FraudReport", "Alert"):
        parsed = parse(schemas.avro_schema(name, schemas.RECORDS[name]))
        assert [f.name() for f in parsed.getFields()] == schemas.RECORDS[name].fieldNames()
    parse(schemas.avro_schema("AccountBalance", schemas.ACCOUNT_BALANCE))


def test_avro_round_trip(spark, transactions):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        pytest.skip("spark-avro is not on the session")
    text = schemas.avro_schema("Transaction", schemas.TRANSACTION)
    data = transactions([("a", 1.25, 10)])
    sent = envelope.messages(data, "Transaction", 2)
    assert rows(envelope.records(envelope.decode(sent, {2: Writer("Transaction", text)}, "Transaction"))) == rows(data)


def test_subject():
    assert envelope.subject("transactions") == "transactions-value"


def test_two_decoded_topics_in_one_plan(values):
    a, b = (envelope.records(envelope.decode(values(message(2, TX)), WRITERS, "Transaction", "json")) for _ in range(2))
    assert a.join(b, "id").count() == 1


def test_registered_text_is_written(monkeypatch, spark, transactions, values):
    """Where the registry's schema has its fields in another order, that text is asked for."""
    asked = []
    monkeypatch.setattr(envelope, "to_avro", lambda record, text: asked.append(text) or F.to_json(record).cast("binary"))
    turned = json.loads(schemas.avro_schema("Transaction", schemas.TRANSACTION))
    turned["fields"].reverse()
    writers = WRITERS | {2: Writer("Transaction", json.dumps(turned)), 9: Writer("AccountBalance", "balance text")}
    envelope.messages(transactions([("a", 1, 10)]), "Transaction", 2, writers=writers)
    envelope.balance_messages(balances.account_balances(transactions([("a", 1, 10)])), 8, 9, writers=writers)
    assert asked[0] == json.dumps(turned) and asked[2] == "balance text"
    assert json.loads(asked[1])["name"] == "AccountKey"
