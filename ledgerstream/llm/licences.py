"""Licence notices in documents, by a positional index of rare words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels whose every occurrence counts, and their phrases.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public wordings of licence notices: label, notice, mandatory key phrases.
TEMPLATES = [
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
     ["affero general public license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license", "version 2 0"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
     ["waived all copyright"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
            " Public License as published by the Free Software Foundation", ["gnu general public license"]),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2",
     ["gnu general public license version 2"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
     ["gnu general public license version 3"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted", ["for any purpose with or without fee"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ["lesser general public license"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files", ["permission is hereby granted free of charge"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["released into the public domain"]),
]

COVERAGE = 0.75  # least part of a notice's words found in their places
SHIFT = 2  # words that a place may be off
RAREST = 3  # words of highest IDF that each notice is looked up by
AGREEING = 2  # rare words of a notice that must agree on its place
RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

# Bytes outside words become spaces; A-Z become lower case; all bytes of other letters are in words.
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_SPLIT).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    keys: list[list[bytes]]
    base: bool


class Index:
    """Postings (template, position) of each template's rarest words.

    A word's IDF counts the templates that hold it. A file's words are looked up here, so only places around a rare
    licence word are held against the notices.
    """

    def __init__(self, base: dict[str, str] = BASE, templates=TEMPLATES):
        self.templates = [Template(label, words_of(phrase), [words_of(phrase)], True) for phrase, label in base.items()]
        self.templates += [Template(label, words_of(text), [words_of(k) for k in keys], False)
                           for label, text, keys in templates]
        held = Counter(w for t in self.templates for w in set(t.words))
        idf = {w: math.log((1 + len(self.templates)) / n) for w, n in held.items()}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for n, t in enumerate(self.templates):
            # A base phrase is looked up by one word; one place of that word gives one place of the phrase.
            ranked = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], -len(t.words[i]), i))
            rare = [t.words[i] for i in ranked if not t.base or t.words.count(t.words[i]) == 1][:1 if t.base else RAREST]
            for i, w in enumerate(t.words):
                if w in rare:
                    self.postings[w].append((n, i))

        # Rare words that must agree on a notice's place.
        self.needed = [min(AGREEING, sum(any(m == n for m, _ in held) for held in self.postings.values()))
                       for n in range(len(self.templates))]

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        votes: dict[int, dict[int, set[bytes]]] = defaultdict(lambda: defaultdict(set))  # template -> start -> its words
        for place in [i for i, w in enumerate(words) if w in self.postings]:
            for n, i in self.postings[words[place]]:
                votes[n][place - i].add(words[place])
        places, base, labels, best = [], set(), set(), 0.0
        for n, starts in votes.items():
            t = self.templates[n]
            if t.base:
                found = [s for s in starts if s >= 0 and words[s:s + len(t.words)] == t.words]
                places += found
                if found:
                    base.add(t.label)
                    best = 1.0
                continue
            for start in self._agreed(starts, self.needed[n]):
                covered = self._covered(t.words, words, start)
                low, high = max(start - SHIFT, 0), start + len(t.words) + SHIFT
                if covered > best and all(_holds(words[low:high], k) for k in t.keys):
                    best = covered
                if covered >= COVERAGE and t.label not in labels and all(_holds(words[low:high], k) for k in t.keys):
                    labels.add(t.label)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | labels)), best)

    @staticmethod
    def _agreed(starts: dict[int, set[bytes]], needed: int) -> list[int]:
        """The intersection of the postings: starts that so many different rare words give, ``SHIFT`` words off at most."""
        return [s for s in starts
                if len(set().union(*(starts.get(s + d, ()) for d in range(-SHIFT, SHIFT + 1)))) >= needed]

    @staticmethod
    def _covered(template: list[bytes], words: list[bytes], start: int) -> float:
        """Part of the template's words that stand in their places, by one shift or by one that grows or shrinks."""
        found, shift = 0, 0
        for i, w in enumerate(template):
            for s in sorted(range(-SHIFT, SHIFT + 1), key=lambda s: abs(s - shift)):
                if 0 <= start + i + s < len(words) and words[start + i + s] == w:
                    found, shift = found + 1, s
                    break
        return found / len(template)


def _holds(words: list[bytes], phrase: list[bytes]) -> bool:
    return any(words[i:i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


def scan(text: Column) -> Column:
    """A struct for each text: words, base phrases and their places, labels, and how well the best notice is covered.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. ``n_base``
    counts each place of each base phrase (its words consecutive), ``first_word`` and ``last_word`` are the smallest and
    largest of them, null if there is none. Each notice is looked up by its words of highest IDF; where two of them at least
    agree on where the notice would start, within two words, is a place, and the notice's label is given if 75 % of its words are found there in
    their relative positions (two words off at most) and its key phrases stand there word by word. ``score`` is
    the largest such part over places with all key phrases, 1 for a base phrase, 0 for none. A null text is an empty one.
    Repeated phrases count each; labels are distinct and sorted. Whole texts are read, whatever their length.
    """

    @F.pandas_udf(RESULT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index, names = Index(), [c.split()[0] for c in RESULT.split(", ")]
        for texts in batches:
            found = pd.DataFrame([index.scan(t) for t in texts], columns=names)
            yield found.astype({"first_word": "Int64", "last_word": "Int64"})

    return of(text)
