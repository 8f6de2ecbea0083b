import zlib
from collections import Counter, defaultdict

import pytest

from ledgerstream.llm import sharding
from .conftest import AWKWARD


def brute(rows, n):
    import hashlib
    def key(r):
        digest = hashlib.md5(r[1].encode()).hexdigest() if r[1] is not None else ""
        return digest, -1 if r[0] is None else r[0]
    order = sorted(rows, key=key)
    total = sum(len((r[1] or "").encode()) + 16 for r in order)
    out, before, slots = [], 0, Counter()
    for r in order:
        size = len((r[1] or "").encode()) + 16
        shard = n * (2 * before + size) // (2 * total)
        out.append((r[0], size, None if r[1] is None else zlib.crc32(r[1].encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 3, 40])
def test_like_brute_force(awkward, n):
    assert sorted(map(tuple, sharding.shards(awkward, n).collect()), key=repr) == brute(AWKWARD, n)


def test_extra_columns_do_not_matter(clashing, awkward):
    found = sharding.shards(clashing, 5, keep=("source",))
    assert found.columns == ["doc_id", "source", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert found.drop("source").exceptAll(sharding.shards(awkward, 5)).count() == 0


def test_hot_text_spreads_and_shards_are_equal(documents):
    rows = [(i, "hot " * 20 if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(3000)]
    found = sharding.shards(documents(rows), 40).collect()
    bytes_of, slots = Counter(), defaultdict(list)
    for r in found:
        bytes_of[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(bytes_of) == set(range(40))
    largest = max(r.size for r in found)
    assert max(bytes_of.values()) - min(bytes_of.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r.doc_id for r in found) == Counter(range(3000))


def test_empty(documents):
    assert sharding.shards(documents([]), 40).count() == 0


def test_no_python_in_the_plan(awkward):
    plan = sharding.shards(awkward, 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
