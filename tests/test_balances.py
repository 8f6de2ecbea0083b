import random
from datetime import datetime, timedelta

import pytest

from helpers import MINUTE, finish, rows, stream, write_file
from ledgerstream import schemas
from ledgerstream.operators import balances
from ledgerstream.streaming import sinks

DATA = [("a", 10, 3), ("a", -4, 3), ("b", 0, 5), ("a", 1, 1)]


def at(millis):
    return datetime(1970, 1, 1) + timedelta(milliseconds=millis)


def test_total_and_latest_event_time(transactions):
    found = balances.account_balances(transactions(DATA))
    assert [f.dataType for f in found.schema] == [f.dataType for f in schemas.ACCOUNT_BALANCE]
    assert rows(found) == [("a", 7.0, at(3)), ("b", 0.0, at(5))]


def test_withdrawals_add(transactions):
    assert rows(balances.account_balances(transactions([("a", 5, 1, 1), ("a", 5, 1, 2)])), "total_balance") == [(10.0,)]


def test_history(transactions):
    found = balances.account_history(transactions(DATA)).filter("account_id = 'a'").first()
    assert (found.transaction_count, found.total_amount, found.min_amount, found.max_amount) == (3, 7.0, -4.0, 10.0)
    assert (found.first_seen, found.last_seen) == (1, 3)
    assert abs(found.stddev_amount - 7.0945988845975875) < 1e-9


def run_balances(spark, folder):
    changes = balances.account_balances(stream(spark, f"{folder}/in"))
    return finish(sinks.upsert_files(changes, f"{folder}/table", ["account_id"]), spark, "balances",
                  str(folder))


def test_stream_equals_batch_across_a_restart(spark, transactions, tmp_path):
    """Late rows count, and a restarted query goes on from its state."""
    rng = random.Random(1)
    data = [(f"k{rng.randrange(4)}", rng.randrange(100), rng.randrange(100) * MINUTE) for _ in range(60)]
    for batch in (data[:20], data[20:25]):
        write_file(transactions(batch), f"{tmp_path}/in")
    run_balances(spark, tmp_path)
    write_file(transactions(data[25:]), f"{tmp_path}/in")
    query = run_balances(spark, tmp_path)
    assert [p.batchId for p in query.recentProgress if p.numInputRows] == [2]
    table = sinks.read_upserts(spark, f"{tmp_path}/table", ["account_id"])
    assert rows(table) == rows(balances.account_balances(transactions(data)))


def test_late_row_is_kept(spark, transactions, tmp_path):
    for batch in ([("a", 1, 1), ("a", 2, 2)], [("b", 5, 20)], [("b", 6, 21)], [("a", 100, 3)], [("b", 7, 40), ("b", 8, 60)]):
        write_file(transactions([(k, v, t * MINUTE) for k, v, t in batch]), f"{tmp_path}/in")
    run_balances(spark, tmp_path)
    table = sinks.read_upserts(spark, f"{tmp_path}/table", ["account_id"])
    assert rows(table, "account_id", "total_balance") == [("a", 103.0), ("b", 26.0)]


def test_history_as_a_stream(spark, transactions, tmp_path):
    for row in DATA:
        write_file(transactions([row]), f"{tmp_path}/in")
    changes = balances.account_history(stream(spark, f"{tmp_path}/in"))
    finish(sinks.upsert_files(changes, f"{tmp_path}/table", ["account_id"]), spark, "history", str(tmp_path))
    table = sinks.read_upserts(spark, f"{tmp_path}/table", ["account_id"])
    assert rows(table, "account_id", "transaction_count", "total_amount") == [("a", 3, 7.0), ("b", 1, 0.0)]


@pytest.mark.parametrize("cut", [0, 1, 3, 6])
def test_backfill_then_stream_cut_anywhere(spark, transactions, tmp_path, cut):
    """A batch up to the cut, then two micro-batches and a restart; accounts on one side of the cut or on both."""
    path = str(tmp_path)
    items = [("a", 1, 10), ("b", 2, 20), ("a", 4, 30), ("c", -8, 40), ("b", 16, 5), ("d", 32, 60)]
    opened = balances.opening(transactions(items[:cut]))
    opened.coalesce(1).write.parquet(f"{path}/opening")
    rest = [items[cut:][i::2] for i in (0, 1)]

    def run():
        changes = balances.continued(stream(spark, f"{path}/opening", opened.schema), stream(spark, f"{path}/in"))
        finish(sinks.upsert_files(changes, f"{path}/table", ["account_id"]), spark, "continued", path)

    write_file(transactions(rest[0]), f"{path}/in")
    run()
    write_file(transactions(rest[1]), f"{path}/in")
    run()
    found = rows(sinks.read_upserts(spark, f"{path}/table", ["account_id"]))
    assert found == rows(balances.account_balances(transactions(items)))
