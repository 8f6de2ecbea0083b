"""Bank events derived from the ``events`` and ``orders`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerstream.functions import frames
from ledgerstream.sources import files

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Fixed values of the derivation.
_TYPE_IDS = {"signup": 1, "click": 2, "view": 3, "purchase": 4}
_BANKS, _CHAINS = 7, 5
_RISK_FLOORS = ((150, "CRITICAL"), (75, "HIGH"), (25, "MEDIUM"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_batch(spark, f"{sf_dir}/events.parquet", EVENTS)


def events_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = files.PER_BATCH) -> DataFrame:
    # The glob serves a single file as well as a folder of part files.
    return files.read_stream(spark, f"{sf_dir}/events.parquet*", EVENTS, files_per_batch=files_per_batch)


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _is_report() -> Column:
    return F.col("event_type") == "error"


def _transaction() -> list[Column]:
    type_id = F.coalesce(*(F.when(F.col("event_type") == name, code) for name, code in _TYPE_IDS.items()))
    account = F.col("user_id").cast("string")
    return [F.col("event_id").cast("string").alias("id"),
            type_id.alias("transaction_type_id"),
            account.alias("account_id"),
            (F.col("user_id") % _BANKS).cast("string").alias("bank_id"),
            F.col("value").alias("amount_transferred"),
            F.col("props").alias("reason"),
            _millis("ts").alias("timestamp")]


def _fraud_report() -> list[Column]:
    risk = F.coalesce(*(F.when(F.col("value") >= floor, level) for floor, level in _RISK_FLOORS), F.lit("LOW"))
    return [F.concat(F.lit("r"), "event_id").alias("report_id"),
            F.concat(F.lit("c"), F.col("user_id") % _CHAINS).alias("fraud_chain_id"),
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("user_id").cast("string").alias("account_id"),
            (F.col("user_id") % _BANKS).cast("string").alias("bank_id"),
            risk.alias("risk_level"),
            _millis("ts").alias("timestamp")]


def transactions(events: DataFrame) -> DataFrame:
    """The transactions among the events; the filter is on a stored column and reaches the scan."""
    return events.filter(~_is_report()).select(*_transaction())


def fraud_reports(events: DataFrame) -> DataFrame:
    return events.filter(_is_report()).select(*_fraud_report())


def corrupted_envelopes(events: DataFrame) -> DataFrame:
    """Every event as an envelope, some of them broken in the ways the router must survive."""
    no_metadata = F.col("event_id") % 97 == 0
    unknown = F.col("event_id") % 101 == 0
    swapped = F.col("event_id") % 103 == 0
    own = F.when(_is_report(), "FraudReport").otherwise("Transaction")
    other = F.when(_is_report(), "Transaction").otherwise("FraudReport")
    event_type = F.when(unknown, "Refund").when(swapped, other).otherwise(own)
    return events.select(
        "event_id",
        F.when(~no_metadata, F.struct(event_type.alias("event_type"))).alias("metadata"),
        F.struct(F.when(~_is_report(), F.struct(*_transaction())).alias("member0"),
                 F.when(_is_report(), F.struct(*_fraud_report())).alias("member1")).alias("body"))


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as transactions of their customers."""
    orders = files.read_batch(spark, f"{sf_dir}/orders.parquet",
                              "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                              "o_orderdate timestamp_ntz, o_orderpriority string")
    return orders.select(F.col("o_orderkey").cast("string").alias("id"),
                         F.col("o_custkey").cast("string").alias("account_id"),
                         F.col("o_totalprice").alias("amount_transferred"),
                         _millis("o_orderdate").alias("timestamp"))


# Fixed values of the derived messages: schema ids, as a registry would number them.
BANK_EVENT_ID, TRANSACTION_ID, FRAUD_REPORT_ID, UNKNOWN_ID = 1, 2, 3, 99


def corrupted_messages(events: DataFrame) -> DataFrame:
    """Every corrupted envelope as a framed JSON message, some of the messages broken as well."""
    text = F.to_json(F.struct("metadata", "body"))

    def framed(schema_id: int, payload: Column = text) -> Column:
        return frames.frame(schema_id, payload.cast("binary"))

    number = F.col("event_id")
    value = (F.when(number % 89 == 0, F.lit(None).cast("binary"))
             .when(number % 83 == 0, F.concat(F.lit(b"\x01"), framed(BANK_EVENT_ID)))
             .when(number % 79 == 0, framed(UNKNOWN_ID))
             .when(number % 73 == 0, framed(TRANSACTION_ID))
             .when(number % 71 == 0, framed(BANK_EVENT_ID, F.concat(F.lit("<"), text)))
             .when(number % 67 == 0, framed(BANK_EVENT_ID, F.regexp_replace(text, '"account_id":"[^"]*",', "")))
             .otherwise(framed(BANK_EVENT_ID)))
    return corrupted_envelopes(events).select(value.alias("value"))
