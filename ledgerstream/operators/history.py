"""Rows held against what their account did before.

Rows of an account are put in order inside blocks of time only, and what blocks before have left is carried to each by one
row a block, so a busy account spreads over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DAY_MS = 86_400_000


def _block(width_ms: int, at: str = "timestamp") -> Column:
    return F.floor(F.col(at) / width_ms).alias("block")


def unusual_amounts(transactions: DataFrame, deviations: float = 3.0, least: int = 5, block_ms: int = DAY_MS) -> DataFrame:
    """Transactions whose amount lies more than ``deviations`` standard deviations from the mean of all earlier ones of
    the account, where there are ``least`` of them (batch).

    Transactions stand in order of time and id. Amounts are taken relative to the account's mean, so that sums and sums
    of squares can be added from block to block without losing digits: ``usual`` and ``spread`` are the earlier ones'
    mean and sample deviation. An amount that is null or not finite is neither judged nor counted; nor is a
    transaction without account or time.
    """
    amount = F.col("amount_transferred")
    rows = (transactions.select("id", "account_id", "timestamp", amount.alias("amount"), _block(block_ms))
            .dropna(subset=["account_id", "timestamp", "amount"]).filter(F.abs("amount") < float("inf")))  # NaN is above
    means = rows.groupBy("account_id").agg(F.avg("amount").alias("centre"))
    centred = rows.join(means, "account_id").withColumn("off", F.col("amount") - F.col("centre"))
    blocks = centred.groupBy("account_id", "block").agg(
        F.count("*").alias("n"), F.sum("off").alias("s"), F.sum(F.col("off") ** 2).alias("q"))
    before = Window.partitionBy("account_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("account_id", "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
                                                     for c in ("n", "s", "q")])
    inside = (Window.partitionBy("account_id", "block").orderBy("timestamp", "id")
              .rowsBetween(Window.unboundedPreceding, -1))
    held = centred.select("*", F.count("*").over(inside).alias("n"),
                          F.coalesce(F.sum("off").over(inside), F.lit(0.0)).alias("s"),
                          F.coalesce(F.sum(F.col("off") ** 2).over(inside), F.lit(0.0)).alias("q"))
    n, s, q = (F.col(c) + F.col(f"{c}_before") for c in ("n", "s", "q"))
    judged = (held.join(carried, ["account_id", "block"]).withColumn("earlier", n)
              .filter(F.col("earlier") >= max(2, least))
              .withColumn("mean_off", s / F.col("earlier"))
              .withColumn("spread", F.sqrt(F.greatest(q - s * F.col("mean_off"), F.lit(0.0)) / (F.col("earlier") - 1))))
    return (judged.filter(F.abs(F.col("off") - F.col("mean_off")) > deviations * F.col("spread"))
            .select("id", "account_id", "timestamp", F.col("amount").alias("amount_transferred"), "earlier",
                    (F.col("centre") + F.col("mean_off")).alias("usual"), "spread"))


def with_last_report(points: DataFrame, reports: DataFrame, at: str, block_ms: int = DAY_MS) -> DataFrame:
    """``points`` (with ``account_id``) and the account's last report up to each one's time ``at``: an as-of join (batch).

    Adds ``last_report_id``, ``last_risk_level`` and ``last_reported_at``, null where there is none. Of reports of one
    time the one of the largest id counts. Rows without account or time have no report. Each point stays as often as it is.
    """
    fact = F.struct(F.col("timestamp").alias("reported_at"), "report_id", "risk_level")
    facts = (reports.filter("account_id is not null and timestamp is not null")
             .select("account_id", F.col("timestamp").alias("at"), fact.alias("fact")))
    named = points.select(F.col("account_id").alias("account_id"), F.col(at).alias("at"), F.struct("*").alias("point"))
    both = (facts.unionByName(named, allowMissingColumns=True).withColumn("block", F.floor(F.col("at") / block_ms))
            .withColumn("side", F.col("point").isNotNull()))
    # The maximum of structs is the latest report; a null has no part in it.
    inside = Window.partitionBy("account_id", "block").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("account_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = both.groupBy("account_id", "block").agg(F.max("fact").alias("fact"))
    carried = blocks.select(F.col("account_id").alias("account"), F.col("block").alias("of"), F.max("fact").over(before).alias("carried"))
    held = both.withColumn("last", F.max("fact").over(inside)).filter("side")
    same = F.col("account_id").eqNullSafe(F.col("account")) & F.col("block").eqNullSafe(F.col("of"))
    last = F.when(F.col("account_id").isNotNull() & F.col("at").isNotNull(), F.coalesce("last", "carried"))
    return (held.join(carried, same).withColumn("last", last)
            .select("point.*", F.col("last.report_id").alias("last_report_id"), F.col("last.risk_level").alias("last_risk_level"),
                    F.col("last.reported_at").alias("last_reported_at")))
