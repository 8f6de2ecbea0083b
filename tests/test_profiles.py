import bisect
import random

import pytest

from helpers import rows
from ledgerstream.operators import profiles

DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01


def daily(transactions, items):
    return profiles.daily_profiles(transactions([(a, x, START + ms) for a, x, ms in items]))


def test_ranges_of_days_against_exact_values(transactions):
    rng = random.Random(1)
    items = [(f"k{rng.randrange(4)}", rng.randrange(1, 10_000) / 4, rng.randrange(10 * DAY)) for _ in range(500)]
    days = daily(transactions, items)
    for since, until in ((None, None), ("2024-01-03", "2024-01-07"), ("2024-01-09", None), (None, "2024-01-01")):
        low = 0 if since is None else int(since[-2:]) - 1
        high = 99 if until is None else int(until[-2:]) - 1
        expected = {}
        for a, x, ms in items:
            if low <= ms // DAY < high:
                expected.setdefault(a, []).append(x)
        found = {r.account_id: r for r in profiles.profiles(days, since, until, (0.5, 0.9)).collect()}
        assert found.keys() == expected.keys()
        for a, xs in expected.items():
            xs.sort()
            r = found[a]
            assert (r.transaction_count, r.min_amount, r.max_amount) == (len(xs), xs[0], xs[-1])
            assert r.total_amount == pytest.approx(sum(xs))
            assert all(abs(bisect.bisect_left(xs, v) / len(xs) - q) <= 0.02 + 1 / len(xs) for q, v in ((0.5, r.q50), (0.9, r.q90)))


def test_busy_account_within_the_stated_rank_error(spark):
    """100,000 amounts over 50 days: ranks of quantiles from merged sketches against exact ones."""
    rows_ = spark.range(100_000).selectExpr(
        "cast(id as string) id", "1 transaction_type_id", "if(id % 1000 = 0, 'rare', 'busy') account_id", "'b' bank_id",
        "pow(rand(5), 4) * 1e6 amount_transferred", "'' reason", f"{START} + (id % 50) * {DAY} as timestamp")
    exact = sorted(r.amount_transferred for r in rows_.filter("account_id = 'busy'").select("amount_transferred").collect())
    found = profiles.profiles(profiles.daily_profiles(rows_), quantiles=(0.01, 0.5, 0.9, 0.99)).filter("account_id = 'busy'").first()
    assert found.transaction_count == len(exact) == 99_900
    for q, v in ((0.01, found.q1), (0.5, found.q50), (0.9, found.q90), (0.99, found.q99)):
        assert abs(bisect.bisect_left(exact, v) / len(exact) - q) <= 0.0133 * 1.5


def test_amounts_that_are_none(transactions):
    tx = transactions([("a", float("nan"), START), ("a", 2, START), ("b", float("nan"), START)])
    found = profiles.profiles(profiles.daily_profiles(tx), quantiles=(0.5,))
    assert rows(found, "account_id", "transaction_count", "min_amount", "q50") == [("a", 2, 2.0, 2.0), ("b", 1, None, None)]


def test_days_merge_like_their_rows(transactions):
    """Profiles of days made apart and put together are those of all rows."""
    rng = random.Random(2)
    items = [("a", rng.randrange(1000), d * DAY + i) for d in range(4) for i in range(30)]
    apart = daily(transactions, items[:60]).union(daily(transactions, items[60:]))
    columns = ("account_id", "transaction_count", "total_amount", "min_amount", "max_amount", "q50", "q90", "q99")
    assert rows(profiles.profiles(apart), *columns) == rows(profiles.profiles(daily(transactions, items)), *columns)
