import random
import re

import pytest

from helpers import MINUTE, finish, rows, stream, write_file
from ledgerstream.operators import sessions as module
from ledgerstream.operators.sessions import COLUMNS, sessions
from ledgerstream.streaming import sinks


def by_hand(data, gap):
    found = []
    for key in {d[0] for d in data}:
        group = []
        for _, amount, t in sorted((d for d in data if d[0] == key), key=lambda d: d[2]):
            if group and t - group[-1][1] > gap:
                found.append(group)
                group = []
            group.append((key, t, amount))
        found.append(group)
    return sorted(((g[0][0], g[0][1], g[-1][1] + gap, len(g), float(sum(r[2] for r in g))) for g in found), key=repr)


def test_against_brute_force(transactions):
    rng = random.Random(3)
    for gap in (1, 7, 50, 1000):
        data = [(f"k{rng.randrange(3)}", rng.randrange(-9, 9), rng.randrange(2000)) for _ in range(200)]
        assert rows(sessions(transactions(data), gap), *COLUMNS) == by_hand(data, gap)


def test_pause_of_exactly_the_gap_joins(transactions):
    assert rows(sessions(transactions([("a", 1, 0), ("a", 1, 10), ("b", 1, 0), ("b", 1, 11)]), 10),
                "account_id", "transaction_count") == [("a", 2), ("b", 1), ("b", 1)]


@pytest.mark.parametrize("block", [1, 2, 5])
def test_sessions_across_blocks(monkeypatch, transactions, block):
    monkeypatch.setattr(module, "BLOCK", block)
    rng = random.Random(block)
    for gap in (1, 7, 50):
        data = [(f"k{rng.randrange(3)}", rng.randrange(-9, 9), rng.randrange(-300, 700)) for _ in range(250)]
        assert rows(sessions(transactions(data), gap), *COLUMNS) == by_hand(data, gap)


def test_busy_account_shuffles_slices_and_spreads(transactions):
    plan = sessions(transactions([("a", 1, 0)]), 1000)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "hashpartitioning(account_id, block" in re.sub(r"#\d+L?", "", plan)


def test_stream_agrees_with_batch(spark, transactions, tmp_path):
    gap = 5 * MINUTE
    data = [("a", 1, 0), ("a", 2, gap), ("b", 3, 2 * gap), ("a", 4, 9 * gap), ("b", 5, 30 * gap)]
    for row in data:
        write_file(transactions([row]), f"{tmp_path}/in")
    found = sessions(stream(spark, f"{tmp_path}/in"), gap)
    finish(sinks.append_files(found, f"{tmp_path}/out"), spark, "sessions", str(tmp_path))
    closed = [s for s in by_hand(data, gap) if s[2] <= 30 * gap - 10_000]
    assert rows(spark.read.parquet(f"{tmp_path}/out"), *COLUMNS) == closed
