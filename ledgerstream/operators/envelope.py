"""Decode framed messages into records and encode records into framed messages.

The caller passes the writer schemas by id, as a schema registry would list them. The payload codec is
``avro`` (needs the spark-avro package on the session) or ``json`` (built in).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.avro.functions import from_avro, to_avro

from ledgerstream import schemas
from ledgerstream.functions import frames

_CORRUPT = "_corrupt_record"
DECODE_ERRORS = ("null_value", "bad_frame", "unknown_schema", "wrong_record", "decode_error")


@dataclass(frozen=True)
class Writer:
    """One registered writer schema: the record it describes and, for Avro, its text."""

    record: str
    avro: str = ""


def subject(topic: str, part: str = "value") -> str:
    """Registry subject of a topic's keys or values."""
    return f"{topic}-{part}"


def _decode_avro(payload: Column, writers: Mapping[int, Writer], reader: str | None) -> Column:
    options = {"mode": "PERMISSIVE"} | ({"avroSchema": reader} if reader else {})
    return F.coalesce(*(F.when(frames.written_by("value", [i]), from_avro(payload, writer.avro, options))
                        for i, writer in writers.items()))


def _decode_json(payload: Column, struct: T.StructType) -> Column:
    schema = T.StructType([*struct.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(payload.cast("string"), schema, {"columnNameOfCorruptRecord": _CORRUPT})


def _incomplete(value: Column, struct: T.StructType) -> Column:
    """Whether a record, or a record that is present in it, lacks a field: all of them are required."""
    return reduce(or_, (child.isNotNull() & _incomplete(child, field.dataType)
                        if isinstance(field.dataType, T.StructType) else child.isNull()
                        for field in struct.fields for child in [value.getField(field.name)]))


def decode(messages: DataFrame, writers: Mapping[int, Writer], record: str = "BankEvent", codec: str = "avro",
           reader: str | None = None, metrics: str | None = None) -> DataFrame:
    """Decode ``value``; no bad message fails the job.

    Keeps ``value``, adds the fields of ``record`` and ``decode_error`` (null for a good message); a payload that
    lacks a required field is an error too. Counts per error are reported as query metrics under ``metrics``, by
    default a name of its own, as a query may decode several topics. ``reader`` is an Avro schema to resolve older
    writers to.
    """
    metrics = metrics or f"decode-{record}-{uuid.uuid4().hex[:8]}"
    struct = schemas.RECORDS[record]
    expected = {i: w for i, w in writers.items() if w.record == record}
    if not expected:
        raise ValueError(f"no writer schema for {record}")

    readable = frames.written_by("value", expected)
    payload = frames.payload("value")
    decoded = (_decode_json(payload, struct) if codec == "json"
               else _decode_avro(payload, expected, reader))

    fields = [F.col("_decoded").getField(name) for name in struct.fieldNames()]
    empty = reduce(and_, (f.isNull() for f in fields))
    broken = empty
    if codec == "json":  # Avro's own reader checks this
        broken = broken | F.col("_decoded").getField(_CORRUPT).isNotNull() | _incomplete(F.col("_decoded"), struct)
    error = (F.when(F.col("value").isNull(), "null_value")
             .when(~frames.is_framed("value"), "bad_frame")
             .when(~frames.written_by("value", writers), "unknown_schema")
             .when(~readable, "wrong_record")
             .when(broken, "decode_error"))
    # The metrics also keep later filters above the decoding, so that a message is decoded once.
    return (messages.select("value", F.when(readable, decoded).alias("_decoded"))
            .select("value", error.alias("decode_error"),
                    *(f.alias(name) for f, name in zip(fields, struct.fieldNames())))
            .observe(metrics, F.count("*").alias("messages"),
                     *(F.count(F.when(F.col("decode_error") == e, 1)).alias(e) for e in DECODE_ERRORS)))


def records(decoded: DataFrame) -> DataFrame:
    """The good messages, as records."""
    return decoded.filter("decode_error is null").drop("value", "decode_error")


def undecodable(decoded: DataFrame) -> DataFrame:
    """The bad messages: their bytes and what is wrong with them."""
    return decoded.filter("decode_error is not null").select("value", "decode_error")


def encode(record: Column, struct: T.StructType, schema_id: int, codec: str = "avro",
           avro: str | None = None) -> Column:
    """Frame one struct column. A null record gives a null message, a record with a null field fails the job."""
    if codec == "avro":
        return frames.frame(schema_id, to_avro(record, avro or ""))
    missing = reduce(or_, (record.getField(name).isNull() for name in struct.fieldNames()))
    checked = F.when(missing, F.raise_error(F.lit("record has a null field"))).otherwise(
        F.to_json(record).cast("binary"))
    return frames.frame(schema_id, F.when(record.isNotNull(), checked))


def writer_text(writers: Mapping[int, Writer] | None, schema_id: int, record: str, struct: T.StructType,
                namespace: str) -> str:
    """The schema that the registry holds under the id; where the caller lists none, the record's own."""
    registered = (writers or {}).get(schema_id)
    return registered.avro if registered and registered.avro else schemas.avro_schema(record, struct, namespace)


def messages(rows: DataFrame, record: str, schema_id: int, codec: str = "avro", namespace: str = "bank",
             writers: Mapping[int, Writer] | None = None) -> DataFrame:
    """Rows of a flat record as message values, written as ``writers`` has it under ``schema_id``."""
    struct = schemas.RECORDS[record]
    text = writer_text(writers, schema_id, record, struct, namespace)
    return rows.select(encode(F.struct(*struct.fieldNames()), struct, schema_id, codec, text).alias("value"))


def balance_messages(balances: DataFrame, key_id: int, value_id: int, codec: str = "avro",
                     namespace: str = "bank", writers: Mapping[int, Writer] | None = None) -> DataFrame:
    """Balances as keyed messages: in a compacted topic the latest message of an account wins."""
    def column(struct: T.StructType, schema_id: int, name: str) -> Column:
        text = writer_text(writers, schema_id, name, struct, namespace)
        return encode(F.struct(*struct.fieldNames()), struct, schema_id, codec, text)

    key = T.StructType([schemas.ACCOUNT_BALANCE["account_id"]])
    return balances.select(column(key, key_id, "AccountKey").alias("key"),
                           column(schemas.ACCOUNT_BALANCE, value_id, "AccountBalance").alias("value"))
