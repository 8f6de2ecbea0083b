import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstream.llm import langid
from ledgerstream.llm.queries import QUERIES


def slow_vector(text):
    encoder = langid.Encoder()
    out = np.zeros(langid.DIMENSIONS)
    codes = [0] + [int(encoder.symbol[ord(c)]) for c in text.lower()] + [0]
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            a, b, c = (encoder.letters(np.array([x]))[0] for x in (a, b, c))
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


@pytest.mark.parametrize("texts", [["Ab c.", "", "öl 漢字", "x" * 50], ["..."], ["a"]])
def test_vectors_like_one_letter_at_a_time(texts):
    assert np.array_equal(langid.Encoder().encode(texts), np.array([slow_vector(t) for t in texts]))


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 7)
    texts = ["the quick brown fox jumps", "short", "ab cd ef gh ij klmnop", "sevenxx", "eight xx"]
    assert np.array_equal(langid.Encoder().encode(texts), np.array([slow_vector(t) for t in texts]))


def test_awkward_rows(clashing):
    found = clashing.select("doc_id", "text", langid.identify(clashing, clashing).alias("f")).select("*", "f.*").collect()
    assert len(found) == clashing.count()
    for r in found:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und" and r.score == 0) if blank else (r.lang_pred in ("en", "de") and 0 <= r.score <= 1)
    assert next(r.lang_pred for r in found if r.doc_id == 7) == "de"


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "a text", None, "s", 6)])
    assert docs.select(langid.identify(docs, docs).alias("f")).first().f.lang_pred == "und"
    assert documents([]).select(langid.identify(docs, documents([])).alias("f")).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    found = QUERIES["op10_hyperdimensional_langid"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = Counter(r.lang_pred == r.lang for r in rows if r.held_out and r.lang)
    assert right[True] >= 0.97 * sum(right.values()) > 0


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    a, b = (sorted((r.doc_id, r.f.lang_pred) for r in d.select("doc_id", langid.identify(d, d.filter(~held)).alias("f"))
                   .collect()) for d in (docs, other))
    assert a == b


def test_letters_of_other_scripts_have_vectors_of_their_own():
    encoder = langid.Encoder()
    points = np.array([*range(0x4E00, 0x4E00 + 300), *range(0x430, 0x450), *range(0x3B1, 0x3C9)])
    vectors = encoder.letters(encoder.symbol[points]).astype(np.int32)
    products = vectors @ vectors.T
    assert (np.diag(products) == langid.DIMENSIONS).all()
    assert np.abs(products - np.diag(np.diag(products))).max() < 6.5 * langid.DIMENSIONS ** 0.5
    for text in ("漢字かな", "русский язык", "mixed 漢字 and words"):
        expected = np.zeros(langid.DIMENSIONS)
        symbols = [0, *encoder.symbol[[ord(ch) for ch in text]].tolist(), 0]
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            if b:
                expected += encoder.vectors(np.array([a]), np.array([b]), np.array([c]))[0]
        assert (encoder.encode([text])[0] == expected).all()


@pytest.mark.parametrize("texts, letters", [(256, 4000), (1, 1_000_000)])
def test_memory_on_texts_of_many_letters(texts, letters):
    """Peak of an encoder's arrays on random Chinese characters, nearly all of whose trigrams differ."""
    rng = np.random.default_rng(9)
    run = ["".join(map(chr, rng.integers(0x4E00, 0x9FA0, letters))) for _ in range(texts)]
    encoder = langid.Encoder()
    tracemalloc.start()
    encoder.encode(run)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6, peak
