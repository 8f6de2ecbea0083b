"""Phrases whose words stand together more often than their parts: counts of word pairs and triples by tiles.

Words are numbered by frequency, so that a square of the first numbers holds most pairs. Pairs of numbers fall into tiles of
``SIDE`` by ``SIDE`` cells. A tile that many of a block's pairs meet is counted by direct address (one ``bincount``); the
others keep sorted coordinates. Triples are pairs again, of a frequent pair under its own number and a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstream.llm.common import stored

UNKNOWN = "und"
LEAST, LONGEST, KEPT = 10, 3, 2000  # of a phrase: occurrences, words; of a language: phrases
WITHIN = 50  # per cent of a phrase's occurrences inside a longer one that drop it
WORDS, PAIRS = 1 << 18, 1 << 18  # most words and pairs that are numbered; the others go by their hash
SIDE_BITS, LOAD = 9, 1 << 13  # a tile's side; pairs of a block from which on its cells are addressed directly
TILES = 24  # dense tiles a task holds
COORDINATES = 1 << 19  # sorted coordinates a task holds
FILTER_BITS = 27  # at most so many cells (2^n) tell words and pairs that cannot be frequent
BLOCK = 2 << 20  # bytes of text at a time
HASHED = 1 << 62  # from here on an id is a hash
SALTS = 64

BASE, INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 between words, 2 between pieces
KIND[[0x09, 0x20]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _mixed(h: np.ndarray) -> np.ndarray:
    """Hashes, from any 64 bits, as ids from ``HASHED`` on."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return ((h >> np.uint64(2)) | np.uint64(HASHED)).view(np.int64)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(a.view(np.uint64) + BASE).view(np.uint64) * BASE + b.view(np.uint64))


class Words:
    """The words of a block of texts: bytes, hash (with the language's own), and whether one follows another in a piece."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, salts: np.ndarray, powers: Powers):
        """``data``: bytes, in which texts start at ``starts``; ``salts``: their languages'."""
        upper = (data >= 65) & (data <= 90)
        self.low = np.where(upper, data + 32, data).astype(np.uint8)
        kind = KIND[self.low]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edge = starts[(starts > 0) & (starts < len(data))]
        first[edge] = inside[edge]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edge - 1] = inside[edge - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        owner = np.searchsorted(starts, self.start, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        self.follows = np.zeros(len(self.start), bool)
        self.follows[1:] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
        up, down = powers.upto(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        self.salt = salts[owner]
        h = (sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64) * INVERSE
        self.ids = _mixed(h ^ _mixed(self.salt.view(np.uint64)).view(np.uint64))

    def text(self, at: np.ndarray) -> list[str]:
        held = self.low.tobytes()
        return [held[a:b].decode() for a, b in zip(self.start[at].tolist(), self.end[at].tolist(), strict=True)]


class Powers:
    """Powers of the hash's base and of its inverse, as many as a block has bytes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, x, np.uint64))])
                                  for x in (BASE, INVERSE))
        return self.up, self.down


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Blocks of about ``BLOCK`` bytes of the columns ``_text`` (without nulls) and ``_salt``, cut between pieces."""
    powers = Powers()
    for batch in batches:
        texts = batch.column("_text").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        salts = batch.column("_salt").to_numpy()
        if not len(texts) or offsets[-1] == offsets[0]:
            continue
        data = np.frombuffer(texts.buffers()[2], np.uint8)
        at, total = int(offsets[0]), int(offsets[-1])
        while at < total:
            end = min(at + BLOCK, total)
            if end < total:
                edge = int(offsets[np.searchsorted(offsets, end)])
                breaks = np.flatnonzero(KIND[data[end:edge]] == 2)
                end = end + int(breaks[0]) if len(breaks) else edge
            a = int(np.searchsorted(offsets, at, "right")) - 1
            b = int(np.searchsorted(offsets, end, "left"))
            yield Words(data[at:end], np.maximum(offsets[a:b] - at, 0), salts[a:b], powers)
            at = end


class Coordinates:
    """Counts by coordinates, as sorted columns."""

    def __init__(self, n: int):
        self.n, self.held, self.size = n, [], 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.held.append(_summed([*columns, np.ones(len(columns[0]), np.int64)]))
            self.size += len(self.held[-1][0])

    def full(self) -> bool:
        """Whether to hand on what is held, as adding it up does not make it small."""
        if self.size > COORDINATES:
            self.held = [_summed([np.concatenate(c) for c in zip(*self.held, strict=True)])]
            self.size = len(self.held[0][0])
        return self.size > COORDINATES // 2

    def take(self) -> list[np.ndarray]:
        if not self.held:
            return [np.zeros(0, np.int64)] * (self.n + 1)
        found = _summed([np.concatenate(c) for c in zip(*self.held, strict=True)])
        self.held, self.size = [], 0
        return found


def _summed(columns: list[np.ndarray]) -> list[np.ndarray]:
    order = np.lexsort(columns[-2::-1]) if len(columns) > 2 else np.argsort(columns[0])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:-1]])
    at = np.flatnonzero(new)
    return [*[c[at] for c in columns[:-1]], np.add.reduceat(columns[-1], at) if len(at) else columns[-1]]


class Tiles:
    """Counts of pairs of numbers."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.sparse = Coordinates(1)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        tile = ((x >> SIDE_BITS) << 32) | (y >> SIDE_BITS)
        tiles, inverse, met = np.unique(tile, return_inverse=True, return_counts=True)
        cell = ((x & (1 << SIDE_BITS) - 1) << SIDE_BITS) | (y & (1 << SIDE_BITS) - 1)
        direct = np.zeros(len(tiles), bool)
        for i in np.flatnonzero(np.array([t in self.dense for t in tiles.tolist()], bool) | (met >= LOAD)).tolist():
            t = int(tiles[i])
            if t in self.dense or len(self.dense) < TILES:
                direct[i] = True
                held = self.dense.setdefault(t, np.zeros(1 << 2 * SIDE_BITS, np.int64))
                held += np.bincount(cell[inverse == i], minlength=len(held))
        rest = ~direct[inverse]
        self.sparse.add((x[rest] << 32) | y[rest])

    def full(self) -> bool:
        return self.sparse.full()

    def take(self, dense: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        packed, n = self.sparse.take()
        xs, ys, ns = [packed >> 32], [packed & (1 << 32) - 1], [n]
        for tile, held in self.dense.items() if dense else ():
            cell = np.flatnonzero(held)
            xs.append(((tile >> 32) << SIDE_BITS) + (cell >> SIDE_BITS))
            ys.append(((tile & (1 << 32) - 1) << SIDE_BITS) + (cell & (1 << SIDE_BITS) - 1))
            ns.append(held[cell])
        return np.concatenate(xs), np.concatenate(ys), np.concatenate(ns)


class Filter:
    """Cells of hashes: where one is not set, none of the hashes it was made of is met."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        at = (ids >> 8) & (len(self.cells) * 8 - 1)
        return (self.cells[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _filter(table: DataFrame, rows: int, ids: Callable[[pa.RecordBatch], np.ndarray]) -> Filter:
    """The cells of a table's hashes; their number follows ``rows``, up to 2^``FILTER_BITS``."""
    bits = min(max(15, (16 * rows).bit_length()), FILTER_BITS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits, bool)
        for batch in batches:
            held[(ids(batch) >> 8) & (len(held) - 1)] = True
        parts = np.packbits(held, bitorder="little").reshape(-1, 4096)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([parts[i].tobytes() for i in some], pa.binary())],
                                         names=["part", "cells"])

    cells = np.zeros((1 << bits - 3), np.uint8)
    if rows:
        marked = table.mapInArrow(mark, "part long, cells binary").groupBy("part").agg(F.bitmap_or_agg("cells").alias("cells"))
        for row in marked.collect():  # at most 2^FILTER_BITS bits together
            cells[row.part * 4096:(row.part + 1) * 4096] = np.frombuffer(row.cells, np.uint8)
    return Filter(cells)


def _most_frequent(table: DataFrame, most: int, *columns: str) -> pd.DataFrame:
    """Rows from a count ``n`` on that at most ``most`` rows reach, the most frequent first."""
    step = F.floor(F.log2("n") * 8)
    held, least = 0, None
    for row in table.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():  # a few hundred rows
        held += row["count"]
        if held > most:
            break
        least = row.s
    chosen = table.filter(F.lit(False) if least is None else step >= least).select(*columns, "n").toArrow().to_pandas()
    return chosen.sort_values(["n", *columns], ascending=[False, *[True] * len(columns)], ignore_index=True)


class Numbers:
    """Numbers of the most frequent words, by frequency, each language's from a tile's edge on; others keep their hash."""

    def __init__(self, head: pd.DataFrame, others: Filter):
        nth = head.groupby("salt").cumcount().to_numpy() if len(head) else np.zeros(0, np.int64)
        sizes = head.groupby("salt", sort=True).size() if len(head) else pd.Series([], dtype=np.int64)
        padded = -(-sizes.to_numpy() >> SIDE_BITS) << SIDE_BITS
        base = dict(zip(sizes.index, np.cumsum(padded) - padded, strict=True))
        codes = nth + np.array([base[s] for s in head["salt"]], np.int64) if len(head) else nth
        order = np.argsort(head["id"].to_numpy(np.int64))
        self.ids, self.codes = head["id"].to_numpy(np.int64)[order], codes.astype(np.int64)[order]
        self.others = others

    def of(self, ids: np.ndarray) -> np.ndarray:
        """Numbers, hashes of other words that may be frequent, and -1."""
        out = np.where(self.others.may_hold(ids), ids, -1)
        if len(self.ids):
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            hit = self.ids[at] == ids
            out[hit] = self.codes[at[hit]]
        return out


def _word_counts(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _blocks(batches):
            ids, at, n = np.unique(words.ids, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.salt[at]), pa.array(ids), pa.array(words.text(at), pa.string()),
                                              pa.array(n)], names=["salt", "id", "word", "n"])

    return texts.mapInArrow(count, "salt long, id long, word string, n long").groupBy("salt", "id", "word").agg(
        F.sum("n").alias("n"))


def _out(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _pair_counts(texts: DataFrame, numbers: Numbers) -> DataFrame:
    names = ["a", "b", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, others = Tiles(), Coordinates(2)
        for words in _blocks(batches):
            ids = numbers.of(words.ids)
            at = np.flatnonzero(words.follows[1:] & (ids[:-1] >= 0) & (ids[1:] >= 0))
            a, b = ids[at], ids[at + 1]
            numbered = (a < HASHED) & (b < HASHED)
            tiles.add(a[numbered], b[numbered])
            others.add(a[~numbered], b[~numbered])
            if tiles.full():
                yield _out(list(tiles.take(dense=False)), names)
            if others.full():
                yield _out(others.take(), names)
        yield _out(list(tiles.take(dense=True)), names)
        yield _out(others.take(), names)

    return texts.mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _triple_counts(texts: DataFrame, numbers: Numbers, pairs: Filter, head: pd.DataFrame) -> DataFrame:
    """``head``: the numbered pairs (a, b), the most frequent first."""
    names = ["a", "b", "c", "n"]
    of_a, of_b = head["a"].to_numpy(np.int64), head["b"].to_numpy(np.int64)
    hashes = _pair_hash(of_a, of_b)
    order = np.argsort(hashes)
    hashes = hashes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, others = Tiles(), Coordinates(3)

        def numbered(dense: bool) -> pa.RecordBatch:
            x, y, n = tiles.take(dense)
            return _out([of_a[x], of_b[x], y, n], names)

        for words in _blocks(batches):
            ids = numbers.of(words.ids)
            at = np.flatnonzero(words.follows[1:] & (ids[:-1] >= 0) & (ids[1:] >= 0))
            met = _pair_hash(ids[at], ids[at + 1])
            may = pairs.may_hold(met)
            at, met = at[may], met[may]
            both = np.flatnonzero(np.diff(at) == 1)
            at, met = at[both], met[both]
            a, b, c = ids[at], ids[at + 1], ids[at + 2]
            pair = np.full(len(at), -1, np.int64)
            if len(hashes):
                spot = np.minimum(np.searchsorted(hashes, met), len(hashes) - 1)
                known = order[spot]
                hit = (hashes[spot] == met) & (of_a[known] == a) & (of_b[known] == b)
                pair[hit] = known[hit]
            direct = (pair >= 0) & (c < HASHED)
            tiles.add(pair[direct], c[direct])
            others.add(a[~direct], b[~direct], c[~direct])
            if tiles.full():
                yield numbered(dense=False)
            if others.full():
                yield _out(others.take(), names)
        yield numbered(dense=True)
        yield _out(others.take(), names)

    return texts.mapInArrow(count, "a long, b long, c long, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1,000,000 a a / (l r)), exactly: counts up to 10^16."""
    wide = "cast({} as decimal(38, 0))".format
    return F.expr(f"{wide(1000000)} * {a} * {a} div ({wide(l)} * {r})")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, kept: int = KEPT,
         within: int = WITHIN) -> DataFrame:
    """Each language's first ``kept`` phrases of two or three words: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts split at ``. , ; : ! ?`` and line ends into pieces, and those at blanks and tabs into words.
    Per language (null: ``und``), ``n`` counts words and ``a`` a phrase's occurrences inside pieces, all of them;
    candidates have ``a >= least``. ``l`` and ``r`` are the occurrences of the two parts of the lowest-scoring cut (ties:
    the first), ``score`` is floor(1000000 a a / (l r)). A phrase inside a longer candidate with at least ``within`` per
    cent of its occurrences goes. Ranks go by score, then a, then the phrase in byte order, so they have no ties.

    Words are counted first; the most frequent get numbers, for the tiles. A pair counts only if both words are
    frequent, a triple only if both pairs are, which filters of bounded size tell (what passes wrongly falls to ``least``
    in the end, so a filter that fills up costs time and changes nothing). Words and pairs beyond the numbered ones go
    by 62 bits of hash. Counts are added up in each task before they are dealt out, so a word that is everywhere costs
    one row a block. A null or empty text has no words; equal rows count each; a language without phrases has no rows.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.xxhash64(lang).alias("_salt"))
    langs = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("salt")).distinct()

    counts = stored(_word_counts(texts), "phrase-words")
    totals = counts.groupBy("salt").agg(F.sum("n").alias("total"))
    frequent = counts.filter(F.col("n") >= least)
    head = _most_frequent(frequent, WORDS, "salt", "id")
    numbers = Numbers(head, Filter(np.zeros(4096, np.uint8)))
    rest = frequent.count() - len(head)
    if rest:  # the filter is for words without a number
        known = numbers.ids

        def unnumbered(batch: pa.RecordBatch) -> np.ndarray:
            ids = batch.column("id").to_numpy()
            return ids[~np.isin(ids, known)]

        numbers.others = _filter(frequent.select("id"), rest, unnumbered)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            code = ids.copy()
            if len(numbers.ids):
                at = np.minimum(np.searchsorted(numbers.ids, ids), len(numbers.ids) - 1)
                hit = numbers.ids[at] == ids
                code[hit] = numbers.codes[at[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(code), *[batch.column(c) for c in ("salt", "word", "n")]],
                                             names=["code", "salt", "word", "f"])

    words = stored(frequent.mapInArrow(coded, "code long, salt long, word string, f long"), "phrase-numbers")
    pairs = stored(_pair_counts(texts, numbers).filter(F.col("n") >= least), "phrase-pairs")
    may = _filter(pairs, pairs.count(), lambda batch: _pair_hash(batch.column("a").to_numpy(), batch.column("b").to_numpy()))
    triples = stored(_triple_counts(texts, numbers, may, _most_frequent(pairs, PAIRS, "a", "b"))
                     .filter(F.col("n") >= least), "phrase-triples")

    part = lambda name: words.select(
        F.col("code").alias(name), F.col("word").alias(f"word_{name}"), F.col("f").alias(f"f_{name}"),
        F.col("salt").alias(f"salt_{name}"))
    longer = (triples.select("a", "b", "n").union(triples.select("b", "c", "n")).groupBy("a", "b")
              .agg(F.max("n").alias("longest")))
    two = (pairs.join(longer, ["a", "b"], "left").filter(F.coalesce(100 * F.col("longest") < within * F.col("n"), F.lit(True)))
           .join(part("a"), "a").join(part("b"), "b")
           .select(F.col("salt_a").alias("salt"), F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("n").alias("a"),
                   F.col("f_a").alias("l"), F.col("f_b").alias("r"), _score("n", "f_a", "f_b").alias("score")))
    cuts = (triples.join(pairs.withColumnRenamed("n", "n_ab"), ["a", "b"])
            .join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("n_bc")), ["b", "c"])
            .join(part("a"), "a").join(part("b"), "b").join(part("c"), "c")
            .withColumn("first", _score("n", "f_a", "n_bc")).withColumn("second", _score("n", "n_ab", "f_c")))
    early = F.col("first") <= F.col("second")
    three = cuts.select(
        F.col("salt_a").alias("salt"), F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"), F.col("n").alias("a"),
        F.when(early, F.col("f_a")).otherwise(F.col("n_ab")).alias("l"),
        F.when(early, F.col("n_bc")).otherwise(F.col("f_c")).alias("r"), F.least("first", "second").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = two.union(three).withColumn("_salted", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = (some.withColumn("rank", F.row_number().over(Window.partitionBy("salt", "_salted").orderBy(*order)))
            .filter(F.col("rank") <= kept))  # so at most SALTS * kept rows of a language meet
    ranked = (some.withColumn("rank", F.row_number().over(Window.partitionBy("salt").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= kept))
    return ranked.join(totals, "salt").join(langs, "salt").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
