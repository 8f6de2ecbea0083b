import math
import random

import pytest

from helpers import MINUTE, finish, rows, stream, write_file
from ledgerstream import schemas
from ledgerstream.operators import correlation
from ledgerstream.streaming import sinks


@pytest.fixture
def reports(spark):
    """Makes reports from (report, transaction, account, millis) rows."""
    def make(items):
        return spark.createDataFrame([(r, "c", t, a, "b", "LOW", ms) for r, t, a, ms in items], schemas.FRAUD_REPORT)
    return make


@pytest.mark.parametrize("lookback, slice_ms", [(100, 10), (100, 1000), (7, 50), (1000, 1), (0, 5), (1, 1), (50, 30),
                                                (99, 10), (101, 10), (20, 10), (25, 10)])
def test_activity_against_brute_force(transactions, reports, lookback, slice_ms):
    rng = random.Random(lookback)
    tx = [(f"k{rng.randrange(3)}", rng.randrange(1, 9), rng.randrange(-50, 300)) for _ in range(150)]
    fr = [(f"r{i}", "-", f"k{rng.randrange(4)}", rng.randrange(300)) for i in range(40)]
    expected = []
    for r, _, account, ms in fr:
        near = [a for k, a, t in tx if k == account and ms - lookback <= t <= ms]
        expected.append((r, account, ms, len(near), float(sum(near))))
    found = correlation.activity_before(reports(fr + fr[:3]), transactions(tx), lookback, slice_ms)
    assert rows(found, "report_id", "account_id", "reported_at", "transaction_count", "total_amount") == sorted(
        expected, key=repr)


@pytest.mark.parametrize("amounts, total", [
    ([0.00004] * 1000, 0.04), ([1e15, 1.0], 1e15 + 1), ([float("nan"), 1.0], None), ([float("inf"), 2.0], float("inf")),
    ([1e300, 1e-300], 1e300), ([-5.0, 5.0], 0.0)])
def test_amounts_are_summed_whole(transactions, reports, amounts, total):
    fr = [("all", "-", "a", len(amounts)), ("none", "-", "a", -1), ("other", "-", "b", 5)]
    found = {r.report_id: r for r in correlation.activity_before(
        reports(fr), transactions([("a", x, i) for i, x in enumerate(amounts)]), 5000, 10).collect()}
    assert found["all"].transaction_count == len(amounts)
    assert math.isnan(found["all"].total_amount) if total is None else found["all"].total_amount == pytest.approx(total)
    assert found["none"].total_amount == found["other"].total_amount == 0.0 and found["none"].transaction_count == 0


def test_a_bad_amount_counts_only_where_it_is(transactions, reports):
    tx = transactions([("a", float("nan"), 0), ("a", 1, 1000)])
    tx = tx.union(tx.selectExpr("id", "transaction_type_id", "account_id", "bank_id", "cast(null as double)", "reason", "timestamp + 1"))
    found = correlation.activity_before(reports([("r", "-", "a", 1005), ("s", "-", "a", None), ("t", "-", None, 3)]), tx, 100, 10)
    assert rows(found, "report_id", "transaction_count", "total_amount") == [("r", 2, 1.0), ("s", 0, 0.0), ("t", 0, 0.0)]


def test_nothing_runs_while_a_query_is_built(spark, transactions, reports):
    tx, fr = transactions([("a", 1, 10)]), reports([("r", "0", "a", 20)])
    spark.sparkContext.setJobGroup("building", "building")
    try:
        correlation.activity_before(fr, tx)
        correlation.reported_transactions(fr, tx)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_named_transactions_with_copies_and_without_matches(transactions, reports):
    """Most reports name one transaction, which is there twice; some name none that exists, some none at all."""
    tx = transactions([("a", 1, 10), ("b", 2, 20), ("c", 3, 30)])
    tx = tx.union(tx.filter("id = '0'"))
    fr = [(f"r{i}", "0", "a", 100) for i in range(20)] + [("x", "1", "b", 100), ("y", "9", "b", 100), ("z", None, "b", 100)]
    found = correlation.reported_transactions(reports(fr), tx)
    assert rows(found, "report_id", "account_id", "lag_ms") == sorted(
        [(f"r{i}", "a", 90) for i in range(20)] + [("x", "b", 80), ("y", None, None), ("z", None, None)], key=repr)


def test_only_named_transactions_are_looked_at(spark, transactions, reports, tmp_path):
    transactions([("a", 1, 10)] * 50).write.parquet(f"{tmp_path}/tx")
    found = correlation.reported_transactions(reports([("r", "0", "a", 100)]), spark.read.parquet(f"{tmp_path}/tx"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Window") < plan.index("LeftSemi") and "CartesianProduct" not in plan


@pytest.mark.parametrize("spread", [1, 3])
def test_named_transactions_as_a_stream(spark, transactions, reports, tmp_path, spread):
    day = correlation.DAY_MS
    tx = transactions([("a", 1, day), ("b", 2, 3 * day), ("late", 3, 9 * day)])
    write_file(tx.union(tx), f"{tmp_path}/tx")
    write_file(reports([("r1", "0", "a", day + 5), ("r2", "0", "a", day + 6), ("old", "0", "a", 2 * day + 1),
                        ("early", "1", "b", 3 * day - 1), ("r3", "1", "b", 4 * day), ("none", None, "b", 4 * day),
                        ("end", "7", "b", 9 * day)]), f"{tmp_path}/fr")
    found = correlation.reported_transactions_stream(stream(spark, f"{tmp_path}/fr", schemas.FRAUD_REPORT),
                                                     stream(spark, f"{tmp_path}/tx"), spread=spread)
    finish(sinks.append_files(found, f"{tmp_path}/out"), spark, "reported", str(tmp_path))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "report_id", "account_id", "lag_ms") == [
        ("early", None, None), ("none", None, None), ("old", None, None), ("r1", "a", 5), ("r2", "a", 6), ("r3", "b", day)]


def test_streamed_in_many_batches_as_in_one(spark, transactions, reports, tmp_path):
    rng = random.Random(8)
    tx = [("a", i, i * 60_000 + rng.randrange(5000)) for i in range(60)]
    fr = [(f"r{i}", str(rng.randrange(70)), "a", i * 60_000 + 20_000) for i in range(60)]
    whole = transactions(tx)
    for n in range(6):
        write_file(whole.filter(f"cast(id as int) div 10 = {n}"), f"{tmp_path}/tx")
        write_file(reports(fr[10 * n:10 * n + 10]), f"{tmp_path}/fr")
    found = correlation.reported_transactions_stream(stream(spark, f"{tmp_path}/fr", schemas.FRAUD_REPORT), stream(spark, f"{tmp_path}/tx"))
    finish(sinks.append_files(found, f"{tmp_path}/out"), spark, "batches", str(tmp_path))
    batch = {r.report_id: r for r in correlation.reported_transactions(reports(fr), whole).collect()}
    end = min(max(t for _, _, t in tx), max(f[3] for f in fr)) - 10_000
    expected = []
    for r, named, _, at in fr:
        m = batch[r]
        hit = m.lag_ms is not None and 0 <= m.lag_ms <= correlation.DAY_MS
        if hit or at < end:
            expected.append((r, m.account_id if hit else None, m.lag_ms if hit else None))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "report_id", "account_id", "lag_ms") == sorted(expected, key=repr)


SLICE, DELAY_MS, START = 10 * MINUTE, 10_000, 1_700_000_400_000


def look_back_stream(spark, path, name="looks"):
    found = correlation.activity_before_stream(stream(spark, f"{path}/fr", schemas.FRAUD_REPORT), stream(spark, f"{path}/tx"),
                                               6 * SLICE, SLICE, DELAY_MS)
    return finish(sinks.append_files(found, f"{path}/out"), spark, name, path), found.schema


def test_streamed_look_back_equals_the_batch_on_whole_slices(spark, transactions, reports, tmp_path):
    """Several files a side, a restart between, late and repeated reports, accounts without transactions."""
    rng, path = random.Random(8), str(tmp_path)
    tx = [(f"k{rng.randrange(3)}", rng.randrange(1, 9), START + m * MINUTE + rng.randrange(MINUTE)) for m in range(600)]
    fr = [(f"r{i}", "-", f"k{rng.randrange(4)}", START + rng.randrange(600) * MINUTE) for i in range(60)]
    fr.sort(key=lambda r: r[3])
    end = [("end", "-", "k0", START + 2000 * MINUTE)], [("k0", 1, START + 2000 * MINUTE)]
    for i in range(0, 600, 150):
        write_file(transactions(tx[i:i + 150]), f"{path}/tx")
        write_file(reports([r for r in fr if i <= (r[3] - START) // MINUTE < i + 150]), f"{path}/fr")
        if i == 150:
            look_back_stream(spark, path)
    write_file(reports(end[0]), f"{path}/fr")
    write_file(transactions(end[1]), f"{path}/tx")
    query, schema = look_back_stream(spark, path)
    found = rows(spark.read.schema(schema).parquet(f"{path}/out"))
    aligned = [(r, t, a, ms // SLICE * SLICE - 1) for r, t, a, ms in fr]
    whole = correlation.activity_before(reports(aligned), transactions(tx), 6 * SLICE - 1, MINUTE)
    expected = {r.report_id: (r.account_id, r.transaction_count, r.total_amount) for r in whole.collect()}
    assert {r[0]: (r[1], r[3], r[4]) for r in found} == expected and len(found) == len(fr)
    held = {o["operatorName"]: o["numRowsTotal"] for o in query.recentProgress[-1]["stateOperators"]}
    assert held["symmetricHashJoin"] <= 3  # slices and reports that nothing can reach are gone


def test_look_back_of_no_whole_number_of_slices(reports, transactions):
    with pytest.raises(ValueError, match="whole number"):
        correlation.activity_before_stream(reports([]), transactions([]), 100, 30)
