import random

import pytest

from helpers import rows
from ledgerstream import schemas
from ledgerstream.operators import chains


@pytest.fixture
def reports(spark):
    """Makes reports from (account, chain) rows."""
    def make(pairs):
        return spark.createDataFrame([(f"r{i}", c, "t", a, "b", "LOW", i) for i, (a, c) in enumerate(pairs)],
                                     schemas.FRAUD_REPORT)
    return make


def brute(pairs):
    group = {a: a for a, _ in pairs if a is not None}
    moved = True
    while moved:
        moved = False
        least = {}
        for a, c in pairs:
            if a is not None and c is not None:
                least[c] = min(least.get(c, group[a]), group[a])
        for a, c in pairs:
            if a is not None and c is not None and least[c] < group[a]:
                group[a], moved = least[c], True
    members = list(group.values())
    return sorted((a, g, members.count(g)) for a, g in group.items())


def test_random_graphs(reports):
    rng = random.Random(3)
    pairs = [(f"a{rng.randrange(60)}", f"c{rng.randrange(50)}") for _ in range(70)]
    assert rows(chains.fraud_chains(reports(pairs)), "account_id", "group_id", "accounts") == brute(pairs)


def test_long_path_takes_few_rounds(reports, spark, monkeypatch):
    """A path of accounts whose names stand in no order; a round halves it at least."""
    names = [f"{i:03d}" for i in range(200)]
    random.Random(4).shuffle(names)
    pairs = [(n, f"c{j}") for i, n in enumerate(names) for j in (i, i + 1)]
    rounds = []
    moved = chains._moved
    monkeypatch.setattr(chains, "_moved", lambda r, h: rounds.append(1) or moved(r, h))
    assert rows(chains.fraud_chains(reports(pairs)), "account_id", "group_id", "accounts") == [
        (n, "000", 200) for n in sorted(names)]
    assert len(rounds) / 2 <= 8  # log2 of 200


def test_hub_chain_costs_its_rows(reports):
    """One chain of many accounts, and an account in many chains: never pairs of accounts."""
    pairs = [(f"a{i:04d}", "hub") for i in range(2000)] + [("z", f"c{i}") for i in range(300)] + [("a0007", "c5")]
    found = rows(chains.fraud_chains(reports(pairs)), "account_id", "group_id", "accounts")
    assert found == [(a, "a0000", 2001) for a in sorted({a for a, _ in pairs})]


def test_nulls_copies_and_nothing(reports):
    pairs = [("a", None), ("b", "c"), ("b", "c"), (None, "c"), ("d", "c"), (None, None)]
    assert rows(chains.fraud_chains(reports(pairs)), "account_id", "group_id", "accounts") == [
        ("a", "a", 1), ("b", "b", 2), ("d", "b", 2)]
    assert rows(chains.fraud_chains(reports([]))) == []
