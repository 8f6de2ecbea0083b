"""Benchmark passages in documents, by random-walk embedding, bit sampling and exact edit distance."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstream.llm.common import discard, slices, stored

MATCH = "array<struct<item_id:bigint,distance:int,first_word:bigint,end_word:bigint>>"
KINDS = 4096  # of symbols that have random bits of their own
SAMPLED = 4  # steps of a walk that make up a key
AGREEMENT = 0.63  # part of the steps in which a passage of 20 % edits agrees with its item, as measured
BLOCK_BYTES = 2 << 20  # item texts searched for in one pass; more items take more passes
ROWS, CHARS, PIECE = 4096, 4 << 20, 1 << 20  # texts and characters in a slice, words in a piece of a long text
# Scripts that are written without spaces between words: each of their characters counts as a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                      "\U00020000-\U0003ffff]")
LEADS = re.compile(rb"[\xe0\xe1\xe3-\xe9\xef\xf0]")  # first bytes of their characters in UTF-8
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> Iterator[list[bytes]]:
    """Lower-cased words (letters and digits) of a text, in runs; characters of unspaced scripts stand alone."""
    at = 0
    while at < len(text):
        stop = at + CHARS
        while stop < len(text) and text[stop].isalnum() and not UNSPACED.match(text[stop]):  # a word is never cut
            stop += 1
        part = text[at:stop].lower()
        data = part.encode("utf-8", "replace")
        if not part.isascii() and LEADS.search(data):
            data = UNSPACED.sub(r" \g<0> ", part).encode("utf-8", "replace")
        yield data.translate(_SPLIT).split()
        at = stop


def repetitions(recall: float, agreement: float = AGREEMENT, sampled: int = SAMPLED) -> int:
    """Walks needed for a passage that agrees in that part of the steps to share a key with its item."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement ** sampled))


class Items:
    """The items of one pass, their walks and keys."""

    def __init__(self, rows: list[tuple[int, str]], edits: float, min_words: int, recall: float, seed: int):
        self.edits = edits
        split = [(i, [w for run in words_of(t or "") for w in run]) for i, t in rows]
        split = sorted(((i, ws) for i, ws in split if ws), key=lambda x: (len(x[1]), x[0]))
        few = sum(len(ws) < min_words for _, ws in split)
        split = split[few:] + split[:few]  # the short ones last: they take no walk
        self.ids = [i for i, _ in split]
        self.symbols: dict[bytes, int] = {}
        for _, ws in split:
            for w in ws:
                self.symbols.setdefault(w, len(self.symbols) + 1)
        self.pad = len(self.symbols) + 1  # stands behind a text; 0 stands for words of no item
        self.items = [np.array([self.symbols[w] for w in ws], np.int32) for _, ws in split]
        self.walked = len(split) - few
        self.short = self._short()
        self.limits = [int(edits * len(x)) for x in self.items]
        self.reach = max((len(x) + 2 * k + 1 for x, k in zip(self.items, self.limits)), default=1)
        # Items of similar length share one length of windows.
        self.classes: list[list[int]] = []
        for n, item in enumerate(self.items[:self.walked]):
            if not self.classes or len(item) > 1.25 * len(self.items[self.classes[-1][0]]):
                self.classes.append([])
            self.classes[-1].append(n)
        rng = np.random.default_rng(seed)
        self.walks = [self._walk(rng) for _ in range(repetitions(recall))]
        self.masks = [self._masks(item) for item in self.items]

    def _short(self) -> dict[int, tuple[np.ndarray, dict[tuple[int, ...], list[int]]]]:
        """By number of words: which symbols stand at each place of a short item, and the items by their symbols."""
        found: dict[int, tuple[np.ndarray, dict[tuple[int, ...], list[int]]]] = {}
        for n in range(self.walked, len(self.items)):
            item = tuple(self.items[n].tolist())
            there, items = found.setdefault(len(item), (np.zeros((len(item), self.pad + 1), bool), {}))
            there[np.arange(len(item)), item] = True
            items.setdefault(item, []).append(n)
        return found

    def runs(self, tokens: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first token, item) of each run of tokens that is a short item, word by word."""
        for n, (there, items) in self.short.items():
            if len(tokens) < n:
                continue
            may = there[0].take(tokens[:len(tokens) - n + 1])
            for place in range(1, n):
                may &= there[place].take(tokens[place:len(tokens) - n + 1 + place])
            for i in np.flatnonzero(may).tolist():
                for item in items.get(tuple(tokens[i:i + n].tolist()), ()):
                    yield i, item

    def _walk(self, rng: np.random.Generator):
        """Random bits of each step and kind of symbol; for each class its sampled steps, and its items by key."""
        steps = [max(int(1.6 * len(self.items[c[0]])), SAMPLED) for c in self.classes]
        bits = rng.integers(0, 2, (max(steps, default=0), KINDS))
        bits[:, 0] = 0
        tables = []
        for members, n in zip(self.classes, steps):
            sampled = np.sort(rng.choice(n, SAMPLED, replace=False))
            read = np.array([self._read(item, bits, sampled) for item in members], np.int64)
            # What is read up to a sampled step is numbered; a key is the number at the last one.
            number, known = np.zeros(len(members), np.int64), []
            for nth in range(SAMPLED):
                codes, number = np.unique(number * (self.pad + 1) + read[:, nth], return_inverse=True)
                known.append(codes)
            first = np.full(self.pad + 1, -1, np.int32)
            first[known[0]] = np.arange(len(known[0]))
            by_key = [[members[i] for i in np.flatnonzero(number == k)] for k in range(len(known[-1]))]
            tables.append((sampled, first, known, by_key))
        return bits, tables

    def _read(self, item: int, bits: np.ndarray, sampled: np.ndarray) -> list[int]:
        """What the walk over an item reads in the sampled steps."""
        padded = np.append(self.items[item], self.pad)
        kinds, at, read = self.kinds(padded), 0, []
        for step in range(sampled[-1] + 1):
            if step in sampled:
                read.append(int(padded[at]))
            at += int(bits[step, kinds[at]])
        return read

    def kinds(self, tokens: np.ndarray) -> np.ndarray:
        """Symbols of a kind share their random bits, which bounds the tables; the pad is kind 0 and never goes on."""
        return np.where(tokens == self.pad, 0, 1 + tokens % (KINDS - 1)).astype(np.int64)

    @staticmethod
    def _masks(item: np.ndarray) -> dict[int, int]:
        masks: dict[int, int] = {}
        for i, w in enumerate(item.tolist()):
            masks[w] = masks.get(w, 0) | 1 << i
        return masks

    def candidates(self, tokens: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window's first token, item) for each window that shares a key with an item in some walk."""
        unknown = np.concatenate(([0], np.cumsum(tokens == 0)))
        starts = []
        for members in self.classes:
            # Each foreign word costs an edit, so a window with too many of them needs no walk.
            least = len(self.items[members[0]]) - self.limits[members[0]]
            upto = np.minimum(np.arange(len(tokens)) + least, len(tokens))
            few = unknown[upto] - unknown[:-1] <= self.limits[members[-1]]
            starts.append(np.flatnonzero(few & (tokens != self.pad)))
        every = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
        if not len(every):
            return
        kinds = self.kinds(tokens)
        places = [np.searchsorted(every, s) for s in starts]
        for bits, tables in self.walks:
            # Walks that meet stay together, so they are followed once: window -> walk -> position.
            position, walk = every.copy(), np.arange(len(every))
            alive = dict(enumerate((p, np.zeros(len(p), np.int64)) for p in places))
            fresh = set(alive)
            due = defaultdict(list)
            for c, (sampled, *_) in enumerate(tables):
                for nth, step in enumerate(sampled.tolist()):
                    due[step].append((c, nth))
            for step in range(max(due) + 1):
                for c, nth in due.get(step, ()):
                    windows, numbers = alive.pop(c)
                    _, first, known, by_key = tables[c]
                    read = tokens.take(position.take(walk.take(windows)))
                    if nth == 0:
                        fresh.discard(c)
                        numbers = first.take(read)
                        held = numbers >= 0
                    else:
                        codes = numbers.astype(np.int64) * (self.pad + 1) + read
                        numbers = np.minimum(np.searchsorted(known[nth], codes), len(known[nth]) - 1)
                        held = known[nth].take(numbers) == codes
                    windows, numbers = windows[held], numbers[held]
                    if nth < SAMPLED - 1:
                        alive[c] = windows, numbers
                    else:
                        for window, key in zip(every[windows].tolist(), numbers.tolist()):
                            for item in by_key[key]:
                                yield window, item
                if not alive:
                    break
                position += bits[step].take(kinds.take(position))
                if step & (step + 1) == 0 or step % 8 == 7:
                    position, walk = self._together(position, walk, None if fresh else [w for w, _ in alive.values()])

    @staticmethod
    def _together(position: np.ndarray, walk: np.ndarray, alive: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        """Joins walks that have met, and leaves out those that no window in ``alive`` is on."""
        if alive is None:
            new = np.concatenate(([True], position[1:] != position[:-1]))
            return position[new], (np.cumsum(new) - 1).take(walk)
        windows = np.concatenate(alive)
        used = np.zeros(len(position), bool)
        used[walk.take(windows)] = True
        kept = np.flatnonzero(used)
        new = np.concatenate(([True], np.diff(position[kept]) != 0))[:len(kept)]
        number = np.zeros(len(position), np.int64)
        number[kept] = np.cumsum(new) - 1
        walk[windows] = number.take(walk.take(windows))
        return position[kept][new], walk

    def near(self, item: int, region: list[int]) -> bool:
        """Whether some part of the region is within the item's limit of edits (bit-parallel dynamic program)."""
        masks, n = self.masks[item], len(self.items[item])
        full, top = (1 << n) - 1, 1 << (n - 1)
        up, down, score, limit = full, 0, n, self.limits[item]
        for w in region:
            eq = masks.get(w, 0)
            diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
            plus, minus = down | (full & ~(diagonal | up)), up & diagonal
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            if score <= limit:
                return True
            plus, minus = plus << 1 & full, minus << 1 & full
            up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        return False

    def span(self, item: int, region: list[int]) -> tuple[int, int, int]:
        """Distance, first and end position of the part of the region nearest to the item (ties: the first)."""
        row = [(0, i) for i in range(len(region) + 1)]
        for n, w in enumerate(self.items[item].tolist(), 1):
            above, row = row, [(n, 0)]
            for i, v in enumerate(region, 1):
                row.append(min((above[i - 1][0] + (v != w), above[i - 1][1]), (above[i][0] + 1, above[i][1]),
                               (row[-1][0] + 1, row[-1][1])))
        end = min(range(len(row)), key=lambda i: (row[i], i))
        return *row[end], end

    def _widened(self, item: int, tokens: np.ndarray, low: int, high: int, begin: int, end: int) -> tuple[int, int, int]:
        """The nearest part of a region that grows around it as long as that brings it nearer."""
        held = None
        while True:
            distance, first, last = self.span(item, tokens[low:high].tolist())
            found = (distance, low + first, low + last)
            if held and found >= held or distance == 0:
                return min(held or found, found)
            held = found
            low, high = max(found[1] - self.limits[item], begin), min(found[2] + self.limits[item], end)

    def matches(self, texts: list[str]) -> list[list[dict]]:
        """For each text the items it holds, each at its nearest passage."""
        pieces, owners, offsets = [], [], []
        get = self.symbols.get
        for n, text in enumerate(texts):
            runs = [np.fromiter(map(get, run, repeat(0)), np.int32, len(run)) for run in words_of(text)]
            tokens = np.concatenate(runs) if runs else np.zeros(0, np.int32)
            for at in range(0, len(tokens), PIECE):  # pieces overlap by the longest passage
                pieces += [tokens[at:at + PIECE + self.reach], np.array([self.pad], np.int32)]
                owners.append(n)
                offsets.append(at)
        best: list[dict[int, tuple]] = [{} for _ in texts]
        if pieces:
            tokens = np.concatenate(pieces)
            begins = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))[:-1:2]
            ends = begins + [len(p) for p in pieces[::2]]
            for first, item in self.runs(tokens):
                piece = int(np.searchsorted(begins, first, "right")) - 1
                at = first - int(begins[piece]) + offsets[piece]
                found = (0, at, at + len(self.items[item]))
                best[owners[piece]][item] = min(best[owners[piece]].get(item, found), found)
            for window, item in sorted(set(self.candidates(tokens))):
                piece = int(np.searchsorted(begins, window, "right")) - 1
                limit, begin, end = self.limits[item], int(begins[piece]), int(ends[piece])
                if window - begin >= PIECE:
                    continue  # the next piece has all of it
                low, high = max(window - limit, begin), min(window + len(self.items[item]) + limit, end)
                shift, held = offsets[piece] - begin, best[owners[piece]].get(item)
                if held and held[1] - limit <= window + shift <= held[2] or not self.near(item, tokens[low:high].tolist()):
                    continue  # the same passage again, or none
                distance, first, last = self._widened(item, tokens, low, high, begin, end)
                found = (distance, shift + first, shift + last)
                best[owners[piece]][item] = min(held or found, found)
        return [[{"item_id": self.ids[i], "distance": d, "first_word": a, "end_word": b}
                 for i, (d, a, b) in sorted(found.items(), key=lambda x: (self.ids[x[0]], x[1]))] for found in best]


def contamination(benchmark: DataFrame, text: Column, edits: float = 0.2, min_words: int = 5, recall: float = 0.9,
                  seed: int = 11, id_col: str = "item_id", text_col: str = "text") -> Column:
    """The benchmark items that each text holds: an array of item, edit distance, first word and word behind the last.

    A text holds an item if a run of its words is within ``edits`` (a part of the item's words) word edits of it; case
    and punctuation don't count. Windows of about an item's length start at every word of the whole text. A random walk
    reads a window and repeats a word or goes on, by a random bit for the step and the word, so that windows few edits
    apart read the same in most steps; a key is what is read in a few sampled steps. Windows that share a key with an
    item in one of the walks are held against it by exact edit distance. Unchanged passages are always found, those at
    the limit of edits with probability ``recall`` where they agree in 63 % of the steps (as measured at 20 % edits),
    others more often.

    Each item is reported once for a text, at its nearest passage (ties: the first). Equal items are each reported.
    Characters of scripts without spaces count as words. Items of fewer than ``min_words`` words are found where they
    stand word by word: an item of one word is in every text with that word. Items that are null or have no word are
    in none. A null or empty text holds none (empty array). For benchmarks of at most 2 MB of text; ``with_matches``
    takes any.
    """
    items, blocks = _blocks(benchmark, id_col, text_col)
    if blocks > 1:
        raise ValueError(f"a benchmark of more than {BLOCK_BYTES} bytes takes several passes: use with_matches")
    return _finder(_rows(items, 0, 1), edits, min_words, recall, seed)(text)


def with_matches(docs: DataFrame, benchmark: DataFrame, name: str, edits: float = 0.2, min_words: int = 5,
                 recall: float = 0.9, seed: int = 11, id_col: str = "item_id", item_col: str = "text",
                 text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``name`` of the items that ``text_col`` holds, as ``contamination`` finds them.

    Items are searched for in blocks of 2 MB of text, one to a pass over the texts. A pass is written before the next block
    is read, so tasks, driver and plan hold one block, however large the benchmark.
    """
    items, blocks = _blocks(benchmark, id_col, item_col)
    before = None
    for block in range(blocks):
        found = _finder(_rows(items, block, blocks), edits, min_words, recall, seed)(F.col(text_col))
        docs = docs.withColumn(name, F.concat(name, found) if block else found)
        if block < blocks - 1:
            docs = stored(docs, "leaks")
            if before is not None:
                discard(before)
            before = docs
    return docs


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    items = benchmark.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).dropna()
    return items, (items.agg(F.sum(F.octet_length("_t"))).first()[0] or 0) // BLOCK_BYTES + 1


def _rows(items: DataFrame, block: int, blocks: int) -> list[tuple[int, str]]:
    rows = items.filter(F.pmod(F.xxhash64("_t", "_i"), F.lit(blocks)) == block).collect()
    return [(r._i, r._t) for r in sorted(rows)]


def _finder(rows: list[tuple[int, str]], edits: float, min_words: int, recall: float, seed: int):
    @F.pandas_udf(MATCH)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(rows, edits, min_words, recall, seed)
        for texts in batches:
            yield pd.Series([m for _, run in slices(list(texts.fillna("")), ROWS, CHARS) for m in items.matches(run)],
                            dtype=object)

    return find
