"""What is usual for an account over any range of days, from sketches that are kept by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstream.functions import eventtime

PRECISION = 200  # of a sketch: its rank error is about 1.33 % at 200, whatever the number of rows
QUANTILES = (0.5, 0.9, 0.99)


def daily_profiles(transactions: DataFrame, precision: int = PRECISION) -> DataFrame:
    """Per account and day (UTC): count, total, extremes, and a quantile sketch of the amounts as binary.

    Small enough to be kept for ever, and made once: days can be added, ranges read, without the transactions. Amounts
    that are null or NaN count in ``transaction_count`` alone.
    """
    amount = F.when(~F.isnan("amount_transferred"), F.col("amount_transferred"))
    return (transactions.withColumn("amount", amount)
            .groupBy("account_id", F.to_date(eventtime.from_millis()).alias("day"))
            .agg(F.count("*").alias("transaction_count"), F.count("amount").alias("amounts"),
                 F.sum("amount").alias("total_amount"), F.min("amount").alias("min_amount"),
                 F.max("amount").alias("max_amount"),
                 F.expr(f"kll_sketch_agg_double(amount, {int(precision)})").alias("sketch")))


def profiles(daily: DataFrame, since: str | None = None, until: str | None = None,
             quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Profiles of accounts from the days in ``[since, until)``: counts, total, extremes and quantiles of amounts.

    Sketches of days are merged inside each task before the shuffle, so a busy account costs a sketch a task. Quantiles
    are exact while an account has no more amounts than the sketch's precision.
    """
    day = F.col("day")
    inside = [c for c in (since and day >= F.lit(since).cast("date"), until and day < F.lit(until).cast("date")) if c is not None]
    for condition in inside:
        daily = daily.filter(condition)
    merged = daily.groupBy("account_id").agg(
        F.sum("transaction_count").alias("transaction_count"), F.sum("amounts").alias("amounts"),
        F.sum("total_amount").alias("total_amount"), F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"), F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
    return merged.select("account_id", "transaction_count", "total_amount", "min_amount", "max_amount",
                         *[_quantile(q).alias(f"q{q * 100:g}".replace(".", "_")) for q in quantiles])


def _quantile(q: float) -> Column:
    return F.when(F.col("amounts") > 0, F.expr(f"kll_sketch_get_quantile_double(sketch, {float(q)}D)"))
