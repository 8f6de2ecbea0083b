"""Rows of small tables; the session comes from the tests above."""

import pytest

AWKWARD = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "?! ...", None, "a", 6), (None, "no id here at all", "en", "a", 17),
    (4, "the same text as another row has", "en", "a", 31), (4, "the same text as another row has", "en", "a", 31),
    (5, "the same text as another row has", None, "b", 31), (6, "word " * 30_000, "en", "b", 150_000),
    (7, "ein deutscher Satz über Öl und Äpfel", "de", "b", 35), (8, "İstanbul 漢字 \U0001F600 \u0000 x", "en", "b", 20)]


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (doc_id, text) or full rows."""
    def make(rows):
        full = [r if len(r) == 5 else (r[0], r[1], "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return make


@pytest.fixture
def awkward(documents):
    """Nulls, empty and long texts, repeated rows, and texts beyond ASCII."""
    return documents(AWKWARD)


@pytest.fixture
def clashing(awkward):
    """The same with columns whose names operators use themselves."""
    names = ("fingerprint", "copy", "mix_key", "size", "shard", "_key", "_nth", "_held", "_found", "score", "held_out",
             "component_id", "_id", "_fp", "word", "n", "_size", "_row")
    return awkward.selectExpr("*", *[f"'{n}' as `{n}`" for n in names])
