import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerstream.llm import licences
from ledgerstream.llm.licences import BASE, TEMPLATES, Index, scan


def base(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = ["All rights reserved. ALL RIGHTS-RESERVED!", "cc by cc by cc-by", "All  rights\nreserved all rights", "", None, "ccby cc", "é all rights reserved é",
         "GNU general public license, general public license", "all rights all rights reserved reserved", "x_cc_by_y", "cc"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_like_brute_force(text):
    found = Index().scan(text)
    assert found[:5] == base(text) and set(found[4].split(",")) <= set(found[5].split(","))


@pytest.mark.parametrize("label, notice, keys", TEMPLATES)
def test_notices_are_found(label, notice, keys):
    filler = "some words of prose and then the text of it " * 30
    found = Index().scan(filler + notice.upper() + ". " + filler)
    assert label in found[5].split(",") and found[6] == 1.0
    words = notice.split()
    assert label not in Index().scan(filler + " ".join(reversed(words)) + filler)[5].split(",")


def test_key_phrases_are_mandatory():
    assert Index().scan("Released under the MIT old License")[5] == ""
    assert Index().scan("Licensed under the Apache License, Version 1.1")[5] == ""
    assert "apache-2.0" in Index().scan("is licensed under an Apache License, Version 2.0")[5].split(",")


def test_prose_has_no_label():
    assert Index().scan("the public was free to reserve rights under the version of the general 4 0 2 0 by mit " * 50)[5:] == ("", 0.0)


def test_rows(clashing):
    found = clashing.select("doc_id", "text", scan(F.col("text")).alias("f")).select("doc_id", "text", "f.*").collect()
    assert len(found) == 10
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(r.text) for r in found)
    assert clashing.limit(0).select(scan(F.col("text"))).count() == 0


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = docs.select("text", scan(F.col("text")).alias("f")).select("text", "f.*").collect()
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(r.text) for r in found)
    assert any(r.n_base for r in found)


def brute_notices(text):
    """Labels and score from every place of the text that two rare words of a notice agree on."""
    index, words = Index(), licences.words_of(text)
    labels, best = set(base(text)[4].split(",")) - {""}, 1.0 if base(text)[1] else 0.0
    for n, t in enumerate(index.templates):
        if t.base:
            continue
        rare = {w for w, held in index.postings.items() if any(m == n for m, _ in held)}
        places = [(p - i, w) for p, w in enumerate(words) for i, x in enumerate(t.words) if x == w and w in rare]
        for start, _ in places:
            near = {w for s, w in places if abs(s - start) <= licences.SHIFT}
            if len(near) < min(2, len(rare)):
                continue
            low, high = max(start - licences.SHIFT, 0), start + len(t.words) + licences.SHIFT
            some = words[low:high]
            if not all(any(some[i:i + len(k)] == k for i in range(len(some))) for k in t.keys):
                continue
            covered = Index._covered(t.words, words, start)
            best = max(best, covered)
            if covered >= licences.COVERAGE:
                labels.add(t.label)
    return ",".join(sorted(labels)), best


def test_labels_and_score_like_brute_force():
    """Notices whole, cut, with words left out and put in, between prose; and words of notices alone."""
    rng = random.Random(4)
    prose = "the text of it was license software under a version or general public rights use and copy".split()
    hits = 0
    for _, notice, _ in TEMPLATES * 4:
        ws = notice.split()
        for _ in range(rng.randrange(3)):
            del ws[rng.randrange(len(ws))]
        for _ in range(rng.randrange(3)):
            ws.insert(rng.randrange(len(ws) + 1), rng.choice(prose))
        text = " ".join(rng.choices(prose, k=20) + ws[:rng.randrange(1, len(ws) + 1) if rng.random() < 0.3 else len(ws)]
                        + rng.choices(prose, k=20))
        found = Index().scan(text)
        assert (found[5], found[6]) == brute_notices(text)
        hits += bool(found[5])
    assert hits > len(TEMPLATES)


def test_one_rare_word_opens_no_place():
    index = Index()
    for w, held in index.postings.items():
        alone = index.scan(f"some {w.decode()} here")
        assert all(index.needed[n] == 1 or index.templates[n].base or index.templates[n].label not in alone[5].split(",")
                   for n, _ in held)
