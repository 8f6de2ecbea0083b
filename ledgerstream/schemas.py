"""Record types as Spark schemas, and the same types as Avro text for the wire."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Field names, types and symbols of the wire records.
TRANSACTION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("transaction_type_id", T.IntegerType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("bank_id", T.StringType()),
    T.StructField("amount_transferred", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])
FRAUD_REPORT = T.StructType([
    T.StructField("report_id", T.StringType()),
    T.StructField("fraud_chain_id", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("bank_id", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])
ALERT = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("type_id", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("urgency_level", T.IntegerType()),
    T.StructField("window_start", T.LongType()),
    T.StructField("window_end", T.LongType()),
    T.StructField("transaction_count", T.IntegerType()),
    T.StructField("total_amount", T.DoubleType()),
])
ACCOUNT_BALANCE = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("total_balance", T.DoubleType()),
    T.StructField("last_updated", T.TimestampNTZType()),
])
EVENT_TYPES = ("Transaction", "FraudReport")

# A union of records is a struct with one member per branch, exactly one of them non-null.
BANK_EVENT = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("event_type", T.StringType())])),
    T.StructField("body", T.StructType([
        T.StructField("member0", TRANSACTION),
        T.StructField("member1", FRAUD_REPORT),
    ])),
])

RECORDS = {
    "Transaction": TRANSACTION,
    "FraudReport": FRAUD_REPORT,
    "Alert": ALERT,
    "BankEvent": BANK_EVENT,
}

_AVRO_TYPES = {
    T.StringType(): "string",
    T.IntegerType(): "int",
    T.LongType(): "long",
    T.DoubleType(): "double",
    T.TimestampNTZType(): {"type": "long", "logicalType": "local-timestamp-millis"},
}


def _avro_record(name: str, struct: T.StructType, namespace: str) -> dict:
    fields = [{"name": f.name, "type": _AVRO_TYPES[f.dataType]} for f in struct.fields]
    return {"type": "record", "name": name, "namespace": namespace, "fields": fields}


def avro_schema(name: str, struct: T.StructType, namespace: str = "bank") -> str:
    """Avro text of a flat record; every field is required."""
    return json.dumps(_avro_record(name, struct, namespace))


def bank_event_avro_schema(namespace: str = "bank") -> str:
    """Avro text of the envelope: an enum discriminator and a union of the two record types."""
    event_type = {"type": "enum", "name": "EventType", "symbols": list(EVENT_TYPES)}
    metadata = {"type": "record", "name": "EventMetadata",
                "fields": [{"name": "event_type", "type": event_type}]}
    body = [_avro_record("Transaction", TRANSACTION, namespace),
            _avro_record("FraudReport", FRAUD_REPORT, namespace)]
    return json.dumps({
        "type": "record", "name": "BankEvent", "namespace": namespace,
        "fields": [{"name": "metadata", "type": metadata}, {"name": "body", "type": body}],
    })
