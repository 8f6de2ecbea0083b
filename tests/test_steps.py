import pytest

from helpers import finish, rows, stream, write_file
from ledgerstream.operators import balances
from ledgerstream.streaming import sinks, steps


class Dying:
    """A sink that appends, so that a batch it got twice would show; it dies when told to."""

    def __init__(self, path, when=()):
        self.path, self.when = path, set(when)

    def __call__(self, batch, batch_id):
        if batch_id in self.when:
            self.when.discard(batch_id)
            raise RuntimeError("sink died")
        batch.coalesce(1).write.mode("append").parquet(self.path)


def publish(transactions, path, n):
    for i in range(n):
        write_file(transactions([("a", 1, 10 * i), (f"k{i}", 2, 10 * i + 5)]), f"{path}/in")


def run(spark, path, targets):
    finish(steps.write_in_turn(stream(spark, f"{path}/in"), f"{path}/ledger", targets), spark, "steps", path)


def test_death_between_the_sinks(spark, transactions, tmp_path):
    path = str(tmp_path)
    publish(transactions, path, 3)
    targets = {"one": Dying(f"{path}/one"), "two": Dying(f"{path}/two", when=[1])}
    with pytest.raises(Exception, match="sink died"):
        run(spark, path, targets)
    assert spark.read.parquet(f"{path}/one").count() == 4 and spark.read.parquet(f"{path}/two").count() == 2
    run(spark, path, targets)
    found = [rows(spark.read.parquet(f"{path}/{name}"), "account_id", "timestamp") for name in ("one", "two")]
    assert found[0] == found[1] and len(found[0]) == 6


def test_a_sink_that_died_replaces_what_it_wrote(spark, transactions, tmp_path):
    path = str(tmp_path)
    publish(transactions, path, 2)
    held = steps.files(f"{path}/files")
    dead = []

    def late_death(batch, batch_id):
        held(batch, batch_id)
        if not dead:
            dead.append(batch_id)
            raise RuntimeError("died after writing")

    targets = {"files": late_death, "balances": sinks.upsert_batch(f"{path}/table", ["id"])}
    with pytest.raises(Exception, match="died after writing"):
        run(spark, path, targets)
    run(spark, path, targets)
    assert spark.read.parquet(f"{path}/files").count() == 4
    assert sinks.read_upserts(spark, f"{path}/table", ["id"]).count() == 2  # ids start again in each file


def test_another_query_has_its_own_batches(spark, transactions, tmp_path):
    path = str(tmp_path)
    publish(transactions, path, 1)
    run(spark, path, {"one": Dying(f"{path}/one")})
    finish(steps.write_in_turn(stream(spark, f"{path}/in"), f"{path}/ledger", {"one": Dying(f"{path}/one")}), spark, "other",
           f"{path}/other")
    assert spark.read.parquet(f"{path}/one").count() == 4


def test_changed_totals_into_two_sinks(spark, transactions, tmp_path):
    """Update mode: both sinks see the same changes."""
    path = str(tmp_path)
    publish(transactions, path, 3)
    targets = {n: sinks.upsert_batch(f"{path}/{n}", ["account_id"]) for n in ("one", "two")}
    changes = balances.account_balances(stream(spark, f"{path}/in"))
    finish(steps.write_in_turn(changes, f"{path}/ledger", targets, "update"), spark, "totals", path)
    found = [rows(sinks.read_upserts(spark, f"{path}/{n}", ["account_id"]), "account_id", "total_balance") for n in targets]
    assert found[0] == found[1] == [("a", 3.0), ("k0", 2.0), ("k1", 2.0), ("k2", 2.0)]
