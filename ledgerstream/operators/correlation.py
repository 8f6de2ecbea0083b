"""Fraud reports set against transactions.

All results have one row per report. The pairs of an account's reports and transactions are never formed,
since for one busy account they grow with the square of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstream.functions import eventtime

DAY_MS = 86_400_000
MINUTE_MS = 60_000


def reported_transactions(reports: DataFrame, transactions: DataFrame) -> DataFrame:
    """Each report with the transaction it names, if there is one (batch).

    Only transactions that a report names are looked at further; copies of one count once (the latest). Reports
    that name none don't meet the join. A transaction that very many reports name is left to the adaptive
    splitting of skewed joins, which can split the reports' side.
    """
    named = reports.select("report_id", "transaction_id", "risk_level", F.col("timestamp").alias("reported_at"))
    wanted = named.select("transaction_id").dropna().distinct()
    newest = Window.partitionBy("transaction_id").orderBy(F.desc("t.timestamp"), F.desc("t.account_id"),
                                                          F.desc("t.amount_transferred"))
    found = (transactions.select(F.col("id").alias("transaction_id"),
                                 F.struct("timestamp", "account_id", "amount_transferred").alias("t"))
             .join(wanted, "transaction_id", "left_semi")
             .withColumn("copy", F.row_number().over(newest)).filter("copy = 1").drop("copy"))
    none = named.filter("transaction_id is null").withColumn("t", F.lit(None).cast(found.schema["t"].dataType))
    return (named.filter("transaction_id is not null").join(found, "transaction_id", "left").unionByName(none)
            .select("report_id", "transaction_id", "risk_level", "t.account_id", "t.amount_transferred",
                    (F.col("reported_at") - F.col("t.timestamp")).alias("lag_ms")))


def reported_transactions_stream(reports: DataFrame, transactions: DataFrame, lookback: str = "1 day",
                                 delay: str = "10 seconds", spread: int = 1) -> DataFrame:
    """Each report with the transaction it names, where that is at most ``lookback`` older (append mode).

    A report without such a transaction appears with nulls once the watermark has passed it, as none can follow.
    The time bound lets both sides' state expire. Copies of a transaction count once. ``spread`` repeats every
    transaction that often, so that the reports of one transaction are spread over as many tasks.
    """
    r = eventtime.bounded(reports.select("report_id", F.col("transaction_id").alias("named"), "risk_level",
                                         F.pmod(F.xxhash64("report_id"), F.lit(spread)).alias("report_part"),
                                         eventtime.from_millis().alias("report_ts")), delay, "report_ts")
    t = eventtime.bounded(transactions.select("id", "account_id", "amount_transferred",
                                              eventtime.from_millis().alias("ts")), delay)
    t = t.dropDuplicatesWithinWatermark(["id"])
    same = F.col("named") == F.col("id")
    if spread > 1:
        t = t.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
        same &= F.col("report_part") == F.col("part")
    recent = F.col("ts").between(F.col("report_ts") - F.expr(f"interval {lookback}"), F.col("report_ts"))
    return (r.join(t, same & recent, "left_outer")
            .select("report_id", F.col("named").alias("transaction_id"), "risk_level", "account_id",
                    "amount_transferred",
                    (F.unix_millis("report_ts") - F.unix_millis("ts")).alias("lag_ms")))


# Parts of a look-back's total, in the order they are added.
OPENING, FIRST_BLOCK, LAST_BLOCK, CLOSING = range(4)


def activity_before(reports: DataFrame, transactions: DataFrame, lookback_ms: int = DAY_MS,
                    slice_ms: int = MINUTE_MS) -> DataFrame:
    """Count and total of the account's transactions in the ``lookback_ms`` up to each report (batch).

    Time is cut into slices, and slices into blocks of about the look-back's length. A look-back is then the end of
    its first slice, the end of a block of slices, the beginning of the next block and the beginning of its last
    slice. Each part is a running sum within one account's slice or block, so that parts are only ever added:
    amounts of any size, infinities and NaN count just where they are. A null amount counts as a row without amount.

    Transactions are totalled per account and millisecond, and reports of equal account and time look back once, so
    the work of a busy account spreads over its slices and blocks. Copies of a report count once. Nothing is found
    for a report without account or time.
    """
    slice_ms = max(1, min(slice_ms, lookback_ms))
    block = max(1, lookback_ms // slice_ms - 1)  # a look-back's whole slices fill one block or reach into the next
    asked = reports.select("report_id", "account_id", F.col("timestamp").alias("reported_at")).distinct()
    start, end = F.col("at") - lookback_ms, F.col("at")
    first, last = _floor(start, slice_ms) + 1, _floor(end, slice_ms) - 1  # whole slices
    times = asked.select("account_id", F.col("reported_at").alias("at")).dropna().distinct()

    money = (transactions.select("account_id", F.col("timestamp").alias("at"),
                                 F.coalesce("amount_transferred", F.lit(0.0)).alias("amount"))
             .dropna(subset=["account_id", "at"])
             .groupBy("account_id", "at").agg(F.count("*").alias("n"), F.sum("amount").alias("amount")))
    slices = (money.groupBy("account_id", _floor(F.col("at"), slice_ms).alias("at"))
              .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount")))

    # With a look-back of nothing the first and the last slice are the same one.
    edges = _parts(times, [(OPENING, start, F.lit(lookback_ms > 0)), (CLOSING, end, F.lit(True))])
    blocks = _parts(times, [(FIRST_BLOCK, first, first <= last),
                            (LAST_BLOCK, last, (first <= last) & (_floor(last, block) > _floor(first, block)))])
    totals = (_running(money, edges, slice_ms).unionByName(_running(slices, blocks, block))
              .groupBy("account_id", "reported_at")
              .agg(*[F.max(F.when(F.col("part") == p, F.col(c))).alias(f"{c}{p}")
                     for p in range(4) for c in ("n", "amount")]))  # a look-back has each part once
    n = sum((F.coalesce(f"n{p}", F.lit(0)) for p in range(4)), F.lit(0).cast("long"))
    amount = sum((F.coalesce(f"amount{p}", F.lit(0.0)) for p in range(4)), F.lit(0.0))
    totals = totals.select("account_id", "reported_at", n.alias("n"), amount.alias("amount"))
    return asked.join(totals, ["account_id", "reported_at"], "left").select(
        "report_id", "account_id", "reported_at", F.coalesce("n", F.lit(0)).alias("transaction_count"),
        F.coalesce("amount", F.lit(0.0)).alias("total_amount"))


def activity_before_stream(reports: DataFrame, transactions: DataFrame, lookback_ms: int = DAY_MS,
                           slice_ms: int = 60 * MINUTE_MS, delay_ms: int = 10_000) -> DataFrame:
    """Count and total of the account's transactions in the whole slices of the ``lookback_ms`` up to each report
    (append mode): those from the start of the slice ``lookback_ms`` before the report's own, up to its start.

    Transactions are totalled per account and slice first, so a report meets at most ``lookback_ms / slice_ms`` rows,
    however busy the account. Slices meet reports by an interval join and are added up per report: three stateful
    steps in one query, each with the watermark that the one before it leaves. A slice goes from the state when no
    report can reach it any more, a report when its slices are all closed; a report without any appears with zeros.
    Copies of a report count once.
    """
    if lookback_ms % slice_ms:
        raise ValueError("the look-back must be a whole number of slices")
    at = F.timestamp_millis(_floor(F.col("timestamp"), slice_ms) * slice_ms)
    # A report's own slice starts up to a slice before it, so reports look that much later.
    r = eventtime.bounded(reports.select("report_id", "account_id", F.col("timestamp").alias("reported_at"), at.alias("at")),
                          f"{delay_ms + slice_ms} milliseconds", "at")
    r = r.dropDuplicatesWithinWatermark(["report_id"])
    t = eventtime.bounded(transactions.select("account_id", "amount_transferred", eventtime.from_millis().alias("ts")),
                          f"{delay_ms} milliseconds")
    slices = (t.groupBy(F.col("account_id").alias("account"), F.window("ts", f"{slice_ms} milliseconds"))
              .agg(F.count("*").alias("n"), F.sum("amount_transferred").alias("amount"))
              .select("account", "n", "amount", F.window_time("window").alias("slice_end")))
    near = ((F.col("slice_end") >= F.col("at") - F.expr(f"interval {lookback_ms} milliseconds"))
            & (F.col("slice_end") < F.col("at")))
    return (r.join(slices, (F.col("account_id") == F.col("account")) & near, "left_outer")
            .groupBy("at", "report_id", "account_id", "reported_at")
            .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
            .select("report_id", "account_id", "reported_at", F.coalesce("n", F.lit(0)).alias("transaction_count"),
                    F.coalesce("amount", F.lit(0.0)).alias("total_amount")))


def _floor(number: Column, width: int) -> Column:
    return ((number - F.pmod(number, F.lit(width))) / width).cast("long")


def _parts(times: DataFrame, parts: list[tuple[int, Column, Column]]) -> DataFrame:
    """A row for each part of each look-back: where its running sum begins or ends."""
    each = F.array(*[F.when(there, F.struct(F.lit(part).alias("part"), at.alias("at"))) for part, at, there in parts])
    return (times.withColumn("p", F.explode(each)).filter("p is not null")
            .select("account_id", F.col("at").alias("reported_at"), "p.part", "p.at"))


def _running(rows: DataFrame, parts: DataFrame, width: int) -> DataFrame:
    """For each part the rows of its stretch of ``width``: from its place on, or up to it for closing parts."""
    closing = F.col("part").isin(CLOSING, LAST_BLOCK)
    points = rows.withColumn("side", F.lit(1)).unionByName(
        parts.withColumn("side", F.when(closing, 2).otherwise(0)), allowMissingColumns=True)
    stretch = Window.partitionBy("account_id", "stretch").orderBy("at", "side")  # opens, rows, closes
    before = stretch.rowsBetween(Window.unboundedPreceding, 0)
    behind = stretch.rowsBetween(0, Window.unboundedFollowing)

    def total(column: str) -> Column:
        return F.when(closing, F.sum(column).over(before)).otherwise(F.sum(column).over(behind)).alias(column)

    return (points.withColumn("stretch", _floor(F.col("at"), width))
            .select("account_id", "reported_at", "part", total("n"), total("amount"))
            .filter("part is not null"))
