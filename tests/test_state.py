from helpers import finish, rows, stream, write_file
from ledgerstream.operators import balances
from ledgerstream.streaming import sinks, state


def run(spark, path):
    changes = balances.account_balances(stream(spark, f"{path}/in"))
    finish(sinks.upsert_files(changes, f"{path}/table", ["account_id"]), spark, "held", path)


def test_balances_of_each_batch(spark, transactions, tmp_path):
    path = str(tmp_path)
    first, second = transactions([("a", 1, 10), ("b", 2, 20)]), transactions([("a", 5, 30), ("c", -1, 40)])
    write_file(first, f"{path}/in")
    run(spark, path)
    write_file(second, f"{path}/in")
    run(spark, path)  # restarted on its checkpoint
    expected = [rows(balances.account_balances(df)) for df in (first, first.union(second))]
    assert [rows(state.balances(spark, f"{path}/checkpoint", b)) for b in (0, 1)] == expected
    assert rows(state.balances(spark, f"{path}/checkpoint")) == expected[1]
    assert rows(sinks.read_upserts(spark, f"{path}/table", ["account_id"])) == expected[1]


def test_changed_keys_and_operators(spark, transactions, tmp_path):
    path = str(tmp_path)
    for batch in ([("a", 1, 10), ("b", 2, 20)], [("a", 0, 5), ("c", 1, 40)]):  # a's total and latest stay
        write_file(transactions(batch), f"{path}/in")
        run(spark, path)
    changed = state.changed_keys(spark, f"{path}/checkpoint", 0, 1).select("key.account_id", "before", "now").collect()
    assert [(r.account_id, r.before) for r in changed] == [("c", None)]
    listed = state.operators(spark, f"{path}/checkpoint").select("operatorName", "minBatchId", "maxBatchId").collect()
    assert [tuple(r) for r in listed] == [("stateStoreSave", 0, 1)]
