import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstream.llm import decontam
from ledgerstream.llm.decontam import Items


def words(text):
    return [w for run in decontam.words_of(text) for w in run]


def nearest(item, text):
    """Least word edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j - 1] + (v != w), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def passage(rng, n):
    return [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else f"w{rng.randint(0, 4000)}" for _ in range(n)]


def edited(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.5:
            out[at] = f"new{rng.randint(0, 999)}"
        elif kind < 0.75:
            del out[at]
        else:
            out.insert(at, f"more{rng.randint(0, 999)}")
    return out


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    items = [(i, passage(rng, rng.randint(8, 70))) for i in range(60)]
    texts = []
    for n in range(240):
        body = passage(rng, rng.randint(0, 300))
        if n % 2:
            _, item = items[rng.randrange(len(items))]
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, item, rng.randint(0, int(0.25 * len(item))) if n % 4 == 1 else 0)
        texts.append(" ".join(body))
    return [(i, " ".join(ws)) for i, ws in items], texts


def test_like_brute_force(planted):
    items, texts = planted
    held = Items(items, 0.2, 5, 0.9, 11).matches(texts)
    true, found, exact = set(), set(), set()
    for n, text in enumerate(texts):
        for i, item in items:
            d = nearest(words(item), words(text))
            if d <= int(0.2 * len(words(item))):
                true.add((n, i))
                if d == 0:
                    exact.add((n, i))
        found |= {(n, m["item_id"]) for m in held[n]}
        nearest_too = [m["distance"] == nearest(words(dict(items)[m["item_id"]]), words(text)) for m in held[n]]
        assert all(nearest_too)
    assert found <= true and len(found) >= 0.9 * len(true) > 50
    assert exact <= found


def test_places(planted):
    items, texts = planted
    by_id = {i: words(t) for i, t in items}
    for text, held in zip(texts, Items(items, 0.2, 5, 0.9, 11).matches(texts)):
        for m in held:
            assert nearest(by_id[m["item_id"]], words(text)[m["first_word"]:m["end_word"]]) == m["distance"]


def test_bit_parallel_distance_like_the_plain_one(planted):
    items, texts = planted
    own = Items(items, 0.2, 5, 0.9, 11)
    rng = random.Random(3)
    for n in range(len(own.items)):
        for edits in range(0, len(own.items[n]) // 2, 3):
            region = [5, 6] + edited(rng, own.items[n].tolist(), edits) + [7]
            region = [w if isinstance(w, int) else 0 for w in region]
            d, a, b = own.span(n, region)
            assert own.near(n, region) == (d <= own.limits[n]) and nearest(own.items[n].tolist(), region[a:b]) == d


def test_long_texts_in_pieces(monkeypatch, planted):
    items, texts = planted
    whole = Items(items, 0.2, 5, 0.9, 11).matches(texts)
    monkeypatch.setattr(decontam, "PIECE", 40)
    monkeypatch.setattr(decontam, "CHARS", 100)
    assert Items(items, 0.2, 5, 0.9, 11).matches(texts) == whole


def test_case_and_punctuation_do_not_count():
    item = "One two three, four five six seven eight."
    found = Items([(1, item)], 0.2, 5, 0.9, 11).matches(["x " + item.upper().replace(" ", " - ") + " y", "one two three"])
    assert [[m["distance"] for m in f] for f in found] == [[0], []]


def test_awkward_rows(spark, clashing):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "the same text as another row has"), (4, "the same text as another row has"),
                                   (5, "word word")], "item_id bigint, text string")
    found = clashing.select("doc_id", F.inline(decontam.contamination(bench, F.col("text")))).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in found) == sorted(
        [(d, i, 0) for d in (4, 4, 5) for i in (3, 4)] + [(6, 5, 0)]) and clashing.count() == 10


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = documents([(1, "some text of more than five words")])
    assert docs.select(F.size(decontam.contamination(none, F.col("text"))).alias("n")).first().n == 0
    assert documents([]).select(decontam.contamination(none, F.col("text"))).count() == 0


def test_blocks_of_items_give_the_same(monkeypatch, spark, planted, documents):
    items, texts = planted
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(list(enumerate(texts[:80])))
    rows = lambda: sorted(map(tuple, decontam.with_matches(docs, bench, "held").select("doc_id", F.inline("held")).collect()))
    whole = rows()
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 4000)
    exact = lambda found: {r for r in found if r[2] == 0}
    assert exact(rows()) == exact(whole) and whole
    with pytest.raises(ValueError, match="with_matches"):
        decontam.contamination(bench, F.col("text"))


def test_short_items_are_found_word_by_word():
    items = [(1, "four words of it"), (2, "of it"), (3, "Of, it!"), (4, "lone"), (5, "five words are a walk")]
    texts = ["has four words of it in", "four words of", "x of it of it", "lone", "", "a walk: five words are a walk", "of", "it of"]
    found = Items(items, 0.2, 5, 0.9, 11).matches(texts)
    brute = []
    for text in texts:
        ws = words(text)
        own = []
        for i, item in items:
            x = words(item)
            at = [k for k in range(len(ws) - len(x) + 1) if ws[k:k + len(x)] == x]
            if at:
                own.append((i, 0, at[0], at[0] + len(x)))
        brute.append(own)
    assert [[(m["item_id"], m["distance"], m["first_word"], m["end_word"]) for m in f] for f in found] == brute


def test_scripts_without_spaces():
    """A sentence is as many words as it has characters; an edit is one character."""
    item, short = "今天天气很好我们一起去公园散步吧朋友们都来了", "ไทย"
    edited = item[:9] + "要" + item[10:]
    texts = [f"前面的话{item}后面的话", f"x {edited} y", "今天天气", f"ภาษา{short}คือ", "nothing of it"]
    found = Items([(1, item), (2, short)], 0.2, 5, 0.9, 11).matches(texts)
    assert [[(m["item_id"], m["distance"]) for m in f] for f in found] == [[(1, 0)], [(1, 1)], [], [(2, 0)], []]
