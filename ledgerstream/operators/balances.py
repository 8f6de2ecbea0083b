"""Running totals per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstream.functions import eventtime


def account_balances(transactions: DataFrame) -> DataFrame:
    """Total moved and latest event time per account, for ever.

    Every type of transaction adds to the total. As a stream: update mode, and no row is too late.
    """
    return (transactions.groupBy("account_id")
            .agg(F.sum("amount_transferred").alias("total_balance"),
                 F.max(eventtime.from_millis()).cast("timestamp_ntz").alias("last_updated")))


def account_history(transactions: DataFrame) -> DataFrame:
    """What is usual for an account. As a stream: update mode."""
    amount = "amount_transferred"
    return (transactions.groupBy("account_id")
            .agg(F.count("*").alias("transaction_count"),
                 F.sum(amount).alias("total_amount"),
                 F.min(amount).alias("min_amount"),
                 F.max(amount).alias("max_amount"),
                 F.avg(amount).alias("avg_amount"),
                 F.stddev_samp(amount).alias("stddev_amount"),
                 F.min("timestamp").alias("first_seen"),
                 F.max("timestamp").alias("last_seen")))


def opening(transactions: DataFrame) -> DataFrame:
    """What a batch of transactions leaves behind for a stream that goes on from it: a row for each account.

    Written to files and read as a stream, it is the first input of ``continued``.
    """
    return transactions.groupBy("account_id").agg(F.sum("amount_transferred").alias("amount_transferred"),
                                                  F.max("timestamp").alias("timestamp"))


def continued(opened: DataFrame, transactions: DataFrame) -> DataFrame:
    """Balances of a stream of transactions on top of an opening (itself a stream, so that it is taken in once).

    The opening must hold exactly what the stream does not: everything before the stream's starting offsets. State and
    checkpoint then know no difference between the two, and later restarts read neither again. Update mode.
    """
    parts = [rows.select("account_id", "amount_transferred", "timestamp") for rows in (opened, transactions)]
    return account_balances(parts[0].unionByName(parts[1]))
