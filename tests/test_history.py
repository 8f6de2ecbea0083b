import random
import statistics

import pytest

from helpers import rows
from ledgerstream import schemas
from ledgerstream.operators import history


def unusual(items, deviations, least):
    """(account, amount, time) in the order of their ids."""
    out = []
    for account in {a for a, _, _ in items}:
        own = sorted((ms, str(i), x) for i, (a, x, ms) in enumerate(items) if a == account)
        for n, (ms, i, x) in enumerate(own):
            past = [p for _, _, p in own[:n]]
            if n >= max(2, least) and abs(x - statistics.mean(past)) > deviations * statistics.stdev(past):
                out.append((i, account, n, round(statistics.mean(past), 6), round(statistics.stdev(past), 6)))
    return sorted(out)


def found(df):
    return sorted((r.id, r.account_id, r.earlier, round(r.usual, 6), round(r.spread, 6)) for r in df.collect())


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_unusual_like_brute_force(transactions, block):
    """Few blocks and many; equal times; a busy account."""
    rng = random.Random(block)
    items = [(rng.choice("aaaaab"), rng.choice([1, 2, 3, 4, 5, 40]), rng.randrange(200)) for _ in range(300)]
    items = [(a, x + i / 1000, ms) for i, (a, x, ms) in enumerate(items)]
    assert found(history.unusual_amounts(transactions(items), 2.5, 5, block)) == unusual(items, 2.5, 5)


def test_digits_of_large_amounts_are_kept(transactions):
    """Amounts that differ in their last digits: sums of squares alone would lose them."""
    items = [("a", 1e9 + i % 3, i) for i in range(40)] + [("a", 1e9 + 9, 50)]
    (last,) = history.unusual_amounts(transactions(items), 3.0, 5, 10).collect()
    assert last.amount_transferred == 1e9 + 9 and last.spread == pytest.approx(statistics.stdev(x for _, x, _ in items[:40]), rel=1e-6)


def test_amounts_that_do_not_count(transactions):
    tx = transactions([("a", 1, 1), ("a", float("nan"), 2), ("a", 1, 3), ("a", float("inf"), 4), ("a", 1, 5), ("a", 7, 6), (None, 9, 7)])
    assert [(r.id, r.earlier) for r in history.unusual_amounts(tx, 3.0, 3, 2).collect()] == [("5", 3)]
    assert history.unusual_amounts(tx.limit(0)).count() == 0


@pytest.fixture
def reports(spark):
    def make(items):
        return spark.createDataFrame([(r, "c", "t", a, "b", f"L{r}", ms) for r, a, ms in items], schemas.FRAUD_REPORT)
    return make


@pytest.mark.parametrize("block", [1, 13, 10_000])
def test_last_report_like_brute_force(spark, reports, block):
    rng = random.Random(block)
    fr = [(f"r{i}", rng.choice("ab"), rng.randrange(300)) for i in range(40)] + [("x", None, 5), ("y", "a", None)]
    points = [(i, rng.choice(["a", "a", "a", "b", "z", None]), rng.choice([None, *range(320)])) for i in range(200)] + [(7, "a", 100)] * 2
    df = spark.createDataFrame(points, "n int, account_id string, t bigint")
    expected = []
    for n, a, t in points:
        past = [(ms, r) for r, b, ms in fr if b is not None and b == a and ms is not None and t is not None and ms <= t]
        ms, r = max(past, default=(None, None))
        expected.append((n, a, t, r, r and f"L{r}", ms))
    assert rows(history.with_last_report(df, reports(fr), "t", block)) == sorted(expected, key=repr)


def test_no_reports(spark, reports):
    df = spark.createDataFrame([(1, "a", 5)], "n int, account_id string, t bigint")
    assert rows(history.with_last_report(df, reports([]), "t")) == [(1, "a", 5, None, None, None)]
    assert rows(history.with_last_report(df.limit(0), reports([("r", "a", 1)]), "t")) == []
