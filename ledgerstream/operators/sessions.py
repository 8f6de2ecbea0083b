"""Bursts of activity: an account's transactions with no pause longer than a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerstream.functions import eventtime

BLOCK = 1000  # slices of time that are put in order together
COLUMNS = ("account_id", "session_start", "session_end", "transaction_count", "total_amount")


def sessions(transactions: DataFrame, gap_ms: int = 3_600_000, delay: str = "10 seconds") -> DataFrame:
    """One row per session; it ends ``gap_ms`` after its last transaction.

    As a stream: append mode, a session appears once the watermark has passed its end.
    """
    build = _stream_sessions if transactions.isStreaming else _batch_sessions
    return build(transactions, gap_ms, delay).select(*COLUMNS)


def _stream_sessions(transactions: DataFrame, gap_ms: int, delay: str) -> DataFrame:
    timed = eventtime.bounded(transactions.withColumn("ts", eventtime.from_millis()), delay)
    return (timed.groupBy("account_id", F.session_window("ts", f"{gap_ms} milliseconds"))
            .agg(F.count("*").alias("transaction_count"), F.sum("amount_transferred").alias("total_amount"))
            .withColumn("session_start", F.unix_millis("session_window.start"))
            .withColumn("session_end", F.unix_millis("session_window.end")))


def _batch_sessions(transactions: DataFrame, gap_ms: int, delay: str) -> DataFrame:
    """Transactions in one gap-wide slice of time always share a session, so slices are totalled before the
    shuffle and only slices are put in order: a busy account brings one row per slice, not per transaction.

    Slices are put in order by account and block of slices, so a busy account spreads over its blocks. Only the first
    and the last session of a block can go on in another one; only these are put in order by account.
    """
    at = F.col("timestamp")
    number = (at - F.pmod(at, F.lit(gap_ms))) / gap_ms
    slices = (transactions.groupBy("account_id", number.cast("long").alias("slice"))
              .agg(F.min(at).alias("first"), F.max(at).alias("last"),
                   F.count("*").alias("n"), F.sum("amount_transferred").alias("amount"))
              .withColumn("block", F.floor(F.col("slice") / BLOCK)))
    blocks = _joined(slices, ["account_id", "block"], gap_ms)
    newest = F.max("session").over(Window.partitionBy("account_id", "block"))
    blocks = blocks.withColumn("edge", (F.col("session") == 1) | (F.col("session") == newest))
    across = _joined(blocks.filter("edge").drop("session"), ["account_id"], gap_ms)
    return (blocks.filter("not edge").select(*across.columns).unionByName(across)
            .select("account_id", F.col("first").alias("session_start"), (F.col("last") + gap_ms).alias("session_end"),
                    F.col("n").alias("transaction_count"), F.col("amount").alias("total_amount")))


def _joined(rows: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    """Rows of equal keys joined over pauses of at most the gap; ``session`` numbers them from 1."""
    in_order = Window.partitionBy(*keys).orderBy("first")
    pause = F.col("first") - F.lag("last").over(in_order)
    return (rows.withColumn("opens", F.when(pause <= gap_ms, 0).otherwise(1))
            .withColumn("session", F.sum("opens").over(in_order))
            .groupBy(*keys, "session")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"),
                 F.sum("amount").alias("amount")))
