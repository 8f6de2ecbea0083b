"""Fraud alerts from an account's transactions in a tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstream import schemas
from ledgerstream.functions import eventtime
from ledgerstream.functions.rules import AlertRules

WINDOW = "5 minutes"
DELAY = "10 seconds"


def account_windows(transactions: DataFrame, window: str = WINDOW, rules: AlertRules = AlertRules(),
                    delay: str = DELAY) -> DataFrame:
    """Count and total per account and window.

    As a stream: append mode, a window appears once the watermark has passed its end, and rows later
    than ``delay`` are dropped.
    """
    timed = eventtime.bounded(transactions.withColumn("ts", eventtime.from_millis()), delay)
    totals = [F.count("*").cast("int").alias("transaction_count"),
              F.sum("amount_transferred").alias("total_amount")]
    if rules.watched_types:
        totals.append(rules.watched().alias("watched_count"))
    return (timed.groupBy("account_id", F.window("ts", window)).agg(*totals)
            .select("*",
                    F.unix_millis("window.start").alias("window_start"),
                    F.unix_millis("window.end").alias("window_end"))
            .drop("window"))


def alerts(transactions: DataFrame, window: str = WINDOW, rules: AlertRules = AlertRules(),
           delay: str = DELAY) -> DataFrame:
    """One row per account and window that breaks a rule."""
    return (account_windows(transactions, window, rules, delay)
            .filter(rules.fires())
            .withColumn("type_id", rules.type_id())
            .withColumn("urgency_level", rules.urgency())
            .withColumn("reason", rules.reason())
            .select(*schemas.ALERT.fieldNames()))


def window_changes(transactions: DataFrame, window: str = WINDOW, rules: AlertRules = AlertRules(),
                   delay: str = DELAY) -> DataFrame:
    """Every account and window as it stands, with the alert's columns; null urgency where no rule is broken yet.

    For a keyed sink in update mode: a window's row is replaced as transactions come in, so an alert is there before its
    window closes, and one that later amounts take back goes. A window that the watermark has passed changes no more.
    """
    return (account_windows(transactions, window, rules, delay)
            .withColumn("type_id", F.when(rules.fires(), rules.type_id()))
            .withColumn("urgency_level", F.when(rules.fires(), rules.urgency()))
            .withColumn("reason", F.when(rules.fires(), rules.reason()))
            .select(*schemas.ALERT.fieldNames()))


def standing(windows: DataFrame) -> DataFrame:
    """The alerts among windows."""
    return windows.filter("urgency_level is not null")
