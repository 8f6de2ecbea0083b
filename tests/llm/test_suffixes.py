import hashlib
import random
from collections import Counter

import pytest

from ledgerstream.llm import suffixes

from .conftest import AWKWARD


def brute(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    met = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if met[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **how):
    return sorted(map(tuple, suffixes.without_repeats(docs, **how).collect()), key=repr)


def test_random_texts(documents, monkeypatch):
    """Small alphabets make repeats of every kind: overlapping, touching, across the blocks that texts are cut into."""
    monkeypatch.setattr(suffixes, "WINDOWS", 64)
    monkeypatch.setattr(suffixes, "FIRST", 2)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abé", (5, 3, 1), k=rng.randrange(90)))) for i in range(60)]
    for length in (12, 13, 8):
        assert found(documents(rows), length=length) == brute(rows, length)


def test_passages_and_copies(documents):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäß", k=rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, long = text(60), text(400)
    rows = [(i, f"{text(20)} {shared} {text(30)}") for i in range(40)]  # one passage between different neighbours
    rows += [(100 + i, long) for i in range(30)] + [(200, long[:1500] + "X" + long[1501:]), (201, text(200)), (202, shared)]
    rows += [(203, shared + shared), (204, shared[:199]), (205, shared[:200])]
    expected = brute(rows, 200)
    assert found(documents(rows)) == expected
    removed = {r[0]: r[2] for r in expected}
    assert removed[0] >= len(shared.encode()) and removed[100] == len(long.encode()) and removed[201] == 0


def test_awkward(awkward, clashing):
    expected = brute(AWKWARD, 200)
    assert found(awkward) == expected and found(clashing) == expected
    assert found(awkward, length=10) == brute(AWKWARD, 10)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short")], [(1, None), (1, None)]])
def test_nothing_to_remove(documents, rows):
    assert found(documents(rows)) == brute(rows, 200)
