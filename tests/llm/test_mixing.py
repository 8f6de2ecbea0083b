import hashlib
import math
from collections import Counter

import pytest

from ledgerstream.llm import mixing
from .conftest import AWKWARD


def poisson(u, mean):
    p = c = math.exp(-mean)
    k = 0
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def draw(doc_id, mean, seed=17):
    n = max(math.ceil(mean / 8), 1)
    total = 0
    for j in range(1, n + 1):
        bits = hashlib.md5(f"{seed}|{'' if doc_id is None else doc_id}|{j}".encode()).hexdigest()[:13]
        total += poisson((int(bits, 16) + 0.5) / 2 ** 52, mean / n)
    return total


def brute(rows, weights=None, total=1.0):
    size = Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode()) + 1
    weight = {s: (n ** 0.5 if weights is None else weights.get(s, 0)) for s, n in size.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) * total / n for s, n in size.items()}
    return Counter(r for r in rows for _ in range(draw(r[0], rate[r[3]]) if rate[r[3]] else 0))


@pytest.mark.parametrize("weights, total", [(None, 1.0), ({"a": 1, "b": 3}, 2.0), ({None: 1}, 0.002), ({"a": 1}, 0.05)])
def test_like_brute_force(awkward, weights, total):
    found = mixing.mix(awkward, weights, total=total)
    assert Counter(map(tuple, found.select(*awkward.columns).collect())) == brute(AWKWARD, weights, total)


def test_copies_are_numbered_and_columns_kept(clashing):
    found = mixing.mix(clashing, total=3.0)
    assert found.columns[:len(clashing.columns)] == clashing.columns
    assert found.columns[-2:] == ["copy_", "mix_key_"]
    row = [r for r in found.collect() if r.doc_id == 7]
    assert sorted(r["copy_"] for r in row) == list(range(1, len(row) + 1)) and all(r["copy"] == "copy" for r in row)


def test_weights_are_met(documents):
    rows = [(i, "x" * 9, "en", "big" if i % 3 else f"s{i % 2}", 9) for i in range(6000)]
    found = Counter(r.source for r in mixing.mix(documents(rows), {"big": 1, "s0": 2, "s1": 1}, total=2.0).collect())
    for source, want in (("big", 3000), ("s0", 6000), ("s1", 3000)):
        assert abs(found[source] - want) < 6 * math.sqrt(want)


def test_same_rows_whatever_the_partitioning(documents):
    docs = documents([(i, f"text {i}", "en", f"s{i % 5}", 6) for i in range(500)])
    a, b = mixing.mix(docs.repartition(7)), mixing.mix(docs.coalesce(1))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_order_is_global_within_files(documents):
    found = mixing.mix(documents([(i, "t", "en", "s", 1) for i in range(2000)]))
    parts = found.rdd.glom().map(lambda p: [r.mix_key for r in p]).collect()
    assert all(p == sorted(p) for p in parts) and sum(map(len, parts)) > 1500


def test_empty(documents):
    assert mixing.mix(documents([])).count() == 0


def test_many_weights_and_none_that_fit(documents):
    docs = documents([(i, "t", "en", f"s{i % 3}", 1) for i in range(300)])
    many = {f"s{i}": 1.0 for i in range(3000)}
    assert abs(mixing.mix(docs, many).count() - 300) < 100
    assert mixing.mix(docs, {"other": 1.0}).count() == 0 and mixing.mix(docs, {}).count() == 0
