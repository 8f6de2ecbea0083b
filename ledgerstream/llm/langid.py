"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstream.llm.common import slices

DIMENSIONS = 1024
SYMBOLS = 128  # 0 stands for whatever is not a letter; those of European scripts come first, the others by code point
SHIFT = 21  # bits of a symbol
TRIGRAMS = 12288  # distinct trigrams that are bound at a time
UNKNOWN = "und"
NOISE = 190  # trigrams of a text at which its own noise is as large as its language's part, as measured
SLICE_ROWS, PIECE = 256, 1 << 20  # texts and characters encoded at a time


def _symbols() -> np.ndarray:
    """Symbol of each code point; lower-case letters below U+0180 have the first ones, up to the last of ``SYMBOLS``."""
    table, n = np.zeros(sys.maxunicode + 1, np.int32), 0
    for point in range(0x180):
        if chr(point).isalpha() and chr(point) == chr(point).lower():
            n += 1
            table[point] = min(n, SYMBOLS - 1)
    for point in range(0x180, sys.maxunicode + 1):
        if chr(point).isalpha():
            table[point] = SYMBOLS + point
    return table


class Encoder:
    """Sums of trigram vectors. The vectors follow from the seed alone, so every task has the same."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        letters = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dimensions)).astype(np.int8) * 2 - 1
        self.first, self.second, self.own = np.roll(letters, 2, 1), np.roll(letters, 1, 1), letters
        self.dimensions = dimensions
        self.symbol = _symbols()
        self.column = np.zeros(SYMBOLS ** 3, np.int32)

    def letters(self, symbols: np.ndarray) -> np.ndarray:
        """Vectors of letters: drawn for the first ones, from a hash of the code point and the place for the others."""
        out = self.own[np.minimum(symbols, SYMBOLS - 1)]
        other = np.flatnonzero(symbols >= SYMBOLS)
        words = symbols[other].astype(np.uint64)[:, None] * np.uint64(self.dimensions) + np.arange(
            -(-self.dimensions // 64), dtype=np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            words = (words ^ (words >> np.uint64(shift))) * np.uint64(factor)
        bits = np.unpackbits(words.view(np.uint8), axis=1)[:, :self.dimensions]
        out[other] = bits.astype(np.int8) * 2 - 1
        return out

    def vectors(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Binds the letters' vectors, each rotated by its place in the trigram."""
        if max(x.max(initial=0) for x in (a, b, c)) < SYMBOLS:
            return self.first[a] * self.second[b] * self.own[c]
        return np.roll(self.letters(a), 2, 1) * np.roll(self.letters(b), 1, 1) * self.letters(c)

    def encode(self, texts: list[str]) -> np.ndarray:
        """For each text the sum of its trigram vectors; trigrams have a letter in the middle. ``met`` has their numbers."""
        out, self.met = np.zeros((len(texts), self.dimensions)), np.zeros(len(texts), np.int64)
        for first, run in slices([t.lower() for t in texts], SLICE_ROWS, PIECE):
            if len(run) > 1 or len(run[0]) <= PIECE:
                self._add(slice(first, first + len(run)), out, run)
            else:  # a very long text goes in pieces, each with the letters beside it
                for at in range(0, len(run[0]), PIECE):
                    piece = run[0][max(at - 1, 0):at + PIECE + 1]
                    self._add(slice(first, first + 1), out, [piece], lead=at > 0, tail=at + PIECE < len(run[0]))
        return out

    def _add(self, rows: slice, out: np.ndarray, run: list[str], lead: bool = False, tail: bool = False) -> None:
        """Adds a run of texts to their rows. lead, tail: the first, the last letter only stands beside others."""
        out = out[rows]
        joined = "\n" + "\n".join(run) + "\n"
        codes = self.symbol[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
        keep = codes[1:-1] > 0
        keep[:lead], keep[len(keep) - tail:] = False, False
        if not keep.any():
            return
        owner = np.repeat(np.arange(len(run)), [len(t) + 1 for t in run])[:-1][keep]
        self.met[rows] += np.bincount(owner, minlength=len(run))
        if codes.max() < SYMBOLS:  # few enough trigrams to have a column each
            trigrams = ((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:])[keep]
            seen = np.flatnonzero(np.bincount(trigrams, minlength=SYMBOLS ** 3))
            self.column[seen] = np.arange(len(seen), dtype=np.int32)
            column = self.column[trigrams]
            a, b, c = seen // SYMBOLS ** 2, seen // SYMBOLS % SYMBOLS, seen % SYMBOLS
        else:
            wide = codes.astype(np.int64)
            trigrams = ((wide[:-2] << 2 * SHIFT) | (wide[1:-1] << SHIFT) | wide[2:])[keep]
            seen, column = np.unique(trigrams, return_inverse=True)
            a, b, c = seen >> 2 * SHIFT, seen >> SHIFT & (1 << SHIFT) - 1, seen & (1 << SHIFT) - 1
        if len(seen) <= TRIGRAMS:
            counts = np.bincount(owner * len(seen) + column, minlength=len(run) * len(seen))
            out += counts.reshape(len(run), -1).astype(np.float32) @ self.vectors(a, b, c).astype(np.float32)
            return
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, len(seen), TRIGRAMS):
            part = slice(at, min(at + TRIGRAMS, len(seen)))
            some = slice(*np.searchsorted(column, (part.start, part.stop)))
            width = part.stop - at
            counts = np.bincount(owner[some] * width + column[some] - at, minlength=len(run) * width)
            out += counts.reshape(len(run), -1).astype(np.float32) @ self.vectors(a[part], b[part], c[part]).astype(np.float32)


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """The bundle of all texts of each non-null language; languages are taken to be few.

    A task sends one vector for each of its languages, and the sums, one for each language, go to the driver.
    """

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(), {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                held = sums.setdefault(lang, np.zeros(encoder.dimensions))
                for _, run in slices(list(texts), SLICE_ROWS * 8, PIECE * 4):
                    held += encoder.encode(run).sum(0)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "bundle": [v.astype(np.int64) for v in sums.values()]})

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    summed = (labelled.mapInPandas(bundle, "lang string, bundle array<bigint>")
              .select("lang", F.posexplode("bundle").alias("i", "v"))
              .groupBy("lang", "i").agg(F.sum("v").alias("v")))
    # One number for each language and dimension.
    found: dict[str, np.ndarray] = {}
    for row in summed.collect():
        found.setdefault(row.lang, np.zeros(DIMENSIONS))[row.i] = row.v
    return {lang: found[lang] for lang in sorted(found) if found[lang].any()}


def predictor(profiles: dict[str, np.ndarray]):
    """A function of texts that gives each text's language and its cosine with that language's prototype."""
    names = list(profiles)
    unit = np.array([v / np.linalg.norm(v) for v in profiles.values()]).reshape(len(names), DIMENSIONS)

    @F.pandas_udf("lang_pred string, score double, trigrams long")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder()
        for texts in batches:
            langs, scores, met = [], [], []
            for _, run in slices(list(texts.fillna("")), SLICE_ROWS * 8, PIECE * 4):
                vectors = encoder.encode(run)
                met.append(encoder.met)
                length = np.linalg.norm(vectors, axis=1)
                cosines = (vectors @ unit.T) / np.where(length > 0, length, 1)[:, None]
                for cosine, some in zip(cosines, length > 0):
                    best = int(cosine.argmax()) if names and some else -1
                    langs.append(names[best] if best >= 0 else UNKNOWN)
                    scores.append(min(1.0, max(0.0, float(cosine[best]))) if best >= 0 else 0.0)
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "trigrams": np.concatenate([[], *met]).astype(np.int64)})

    return predict


def expected(trigrams: Column) -> Column:
    """About the cosine that a text of so many trigrams has with its own language, by its length alone.

    A sum of n trigrams drawn from a language holds the language's part n times and each one's own noise; the cosine
    follows sqrt(n / (n + ``NOISE``)).
    """
    return F.sqrt(trigrams / (trigrams + F.lit(float(NOISE))))


def identify(docs: DataFrame, learn_from: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Column:
    """A struct of ``lang_pred``, ``score`` and ``trigrams`` (their number) for the texts in ``text_col``, learned from the rows of ``learn_from``.

    Each letter has a random vector of +1 and -1. A trigram's vector is the product of its letters' vectors, each
    rotated by its place; a text's vector is the sum over its trigrams, a language's prototype the sum over its texts.
    A text gets the language of the largest cosine (ties: the first by name), which is its score (negative: 0). Letters
    are lower-cased; whatever is not a letter counts as a word's edge. A text that is null or has no letter gets
    ``und`` and 0, and so does every text if ``learn_from`` has no labelled letter. All rows of ``learn_from`` with a
    text and a language count, whole and once for each repetition; languages with no letter in any text are not learned.
    """
    return predictor(prototypes(learn_from, text_col, lang_col))(F.col(text_col))
