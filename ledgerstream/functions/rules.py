"""Alert rules over one account's totals in one window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Urgency codes of an alert. The rules below produce 2, 3 and 4.
LOW, MEDIUM, HIGH, CRITICAL, EMERGENCY = 1, 2, 3, 4, 5

# Our own codes for which rule fired.
BY_COUNT, BY_AMOUNT, BY_BOTH, BY_TYPE = 1, 2, 3, 4


@dataclass(frozen=True)
class AlertRules:
    """Thresholds, all strict; totals are compared as they are.

    ``watched_types`` with ``max_watched`` is an extra rule on the type of transaction: more than
    ``max_watched`` transactions of those types raise a Medium alert where no other rule fires.
    """

    max_count: int = 10
    max_amount: float = 10000.0
    watched_types: tuple[int, ...] = ()
    max_watched: int = 0

    def too_many(self) -> Column:
        return F.col("transaction_count") > self.max_count

    def too_much(self) -> Column:
        return F.col("total_amount") > self.max_amount

    def too_many_watched(self) -> Column:
        return F.col("watched_count") > self.max_watched if self.watched_types else F.lit(False)

    def watched(self) -> Column:
        """Number of watched transactions, as an aggregate."""
        return F.count(F.when(F.col("transaction_type_id").isin(*self.watched_types), 1)).cast("int")

    def fires(self) -> Column:
        return self.too_many() | self.too_much() | self.too_many_watched()

    def _choose(self, both, amount, count, watched) -> Column:
        return (F.when(self.too_many() & self.too_much(), both)
                .when(self.too_much(), amount)
                .when(self.too_many(), count)
                .when(self.too_many_watched(), watched))

    def urgency(self) -> Column:
        return self._choose(F.lit(CRITICAL), F.lit(HIGH), F.lit(MEDIUM), F.lit(MEDIUM))

    def type_id(self) -> Column:
        return self._choose(F.lit(BY_BOTH), F.lit(BY_AMOUNT), F.lit(BY_COUNT), F.lit(BY_TYPE))

    def reason(self) -> Column:
        amount = F.format_number("total_amount", 2)
        count = F.col("transaction_count").cast("string")
        watched = F.col("watched_count").cast("string") if self.watched_types else F.lit("")
        return self._choose(
            F.concat(F.lit("CRITICAL: High frequency ("), count, F.lit(" transactions) and large total amount ($"),
                     amount, F.lit(")")),
            F.concat(F.lit("HIGH: Large total amount ($"), amount, F.lit(")")),
            F.concat(F.lit("MEDIUM: High frequency ("), count, F.lit(" transactions)")),
            F.concat(F.lit("MEDIUM: Suspicious transaction types ("), watched, F.lit(" transactions)")),
        )
