"""Removal of long strings that occur more than once, by distributed prefix doubling over positions of texts.

Sorting every byte position would move each text's size many times over, so only places that windows pick are sorted:
every window of ``length`` bytes picks the string of half its length that has the least hash, which depends on its bytes
alone, so equal windows pick the same string at the same place and no repeat is lost. Windows that pick the same place
form a run; there is one for some 50 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstream.llm.common import discard, stored

LENGTH = 200
FIRST = 8  # bytes of the first step away from a picked string
WINDOWS = 1 << 20  # windows looked at together
BASE, INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Powers:
    def __init__(self, n: int):
        self.up, self.down = (np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, x, np.uint64))])
                              for x in (BASE, INVERSE))


def _hashes(data: np.ndarray, n: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of the ``n`` bytes at each position."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:len(data)], out=sums[1:])
    return _mixed((sums[n:] - sums[:-n]) * powers.down[:len(data) - n + 1])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """The place of the least of the ``n`` values from each position on; the first of equals."""
    value, place, width = h, np.arange(len(h), dtype=np.int32), 1
    while width < n:
        step = min(width, n - width)
        later = value[step:] < value[:-step]
        place = np.where(later, place[step:], place[:-step])
        value = np.where(later, value[step:], value[:-step])
        width += step
    return place


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = column.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _runs(length: int):
    """Runs of windows of each text that pick the same place: the picked string's hash, and the run's own digest."""
    half = length // 2

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(WINDOWS + length)
        for batch in batches:
            data, offsets = _buffers(batch.column("text"))
            held = memoryview(data)
            for at in range(int(offsets[0]), int(offsets[-1]) - length + 1, WINDOWS):
                some = data[at:at + WINDOWS + length - 1]
                h = _hashes(some, half, powers)
                place = _least(h, length - half + 1)
                starts, ends = offsets[:-1], offsets[1:] - length + 1
                whole = (ends > starts) & (ends > at) & (starts < at + len(place))
                edges = np.zeros(len(place) + 1, np.int32)
                np.add.at(edges, np.maximum(starts[whole] - at, 0), 1)
                np.add.at(edges, np.minimum(ends[whole] - at, len(place)), -1)
                windows = np.flatnonzero(np.cumsum(edges[:-1]))  # that lie in one text
                if not len(windows):
                    continue
                new = np.ones(len(windows), bool)
                new[1:] = (place[windows[1:]] != place[windows[:-1]]) | (np.diff(windows) != 1)
                firsts = np.flatnonzero(new)
                start = windows[firsts]
                stop = windows[np.append(firsts[1:], len(windows)) - 1] + 1
                picked = h[place[start]].view(np.int64)
                start, stop, spot = start + at, stop + at, place[start].astype(np.int64) + at
                digest = b"".join(hashlib.blake2b(held[a:b], digest_size=8).digest()
                                  for a, b in zip(start.tolist(), (stop + length - 1).tolist(), strict=True))
                owner = np.searchsorted(offsets, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(owner)), pa.array(picked), pa.array(np.frombuffer(digest, np.int64)),
                     pa.array(start - offsets[owner]), pa.array(stop - offsets[owner]), pa.array(spot - offsets[owner])],
                    names=["key", "picked", "digest", "start", "stop", "place"])

    return find


def _places(length: int):
    """Each run with its bytes, and the hashes of the pieces that lie before and behind the string it picked.

    ``low`` and ``high`` bound its windows by the bytes they hold before that string.
    """
    half = length // 2
    steps = _steps(length - half)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(2 * length)
        for batch in batches:
            data, offsets = _buffers(batch.column("text"))
            runs = batch.column("runs")
            counts = np.diff(runs.offsets.to_numpy())
            flat = runs.flatten()
            ids, picked, whole, start, stop, place = (flat.field(c).to_numpy(zero_copy_only=False)
                                                      for c in ("id", "picked", "whole", "start", "stop", "place"))
            begin, end = np.repeat(offsets[:-1], counts), np.repeat(offsets[1:], counts)
            if not len(ids):
                continue
            # Pieces of ``steps`` bytes away from the picked string, the nearest first; null where the text ends.
            names = {side: ([], []) for side in ("before", "behind")}
            at = begin + place
            for near, far in zip(steps[:-1], steps[1:], strict=True):
                for side, first, there in (("before", at - far, at - far >= begin),
                                           ("behind", at + half + near, at + half + far <= end)):
                    found = np.zeros(len(ids), np.int64)
                    rows = np.flatnonzero(there)
                    some = data[first[rows][:, None] + np.arange(far - near)].astype(np.uint64) + np.uint64(1)
                    found[rows] = _mixed((some * powers.up[:far - near]).sum(1, dtype=np.uint64)).view(np.int64)
                    names[side][0].append(found)
                    names[side][1].append(~there)
            low, high = place - (stop - 1), place - start
            left = begin + start
            content = [data[i:j].tobytes() for i, j in zip(left.tolist(), (begin + stop + length - 1).tolist(), strict=True)]
            edges = pa.array(np.arange(len(ids) + 1) * (len(steps) - 1), pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(np.stack(found, 1).ravel(), mask=np.stack(absent, 1).ravel()))
                     for found, absent in names.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(picked), pa.array(whole), pa.array(low), pa.array(high), *lists, pa.array(content)],
                names=["id", "picked", "whole", "low", "high", "before", "behind", "content"])

    return emit


def _steps(reach: int) -> list[int]:
    """0, ``FIRST``, twice that and so on, up to ``reach``."""
    steps = [0, min(FIRST, reach)]
    while steps[-1] < reach:
        steps.append(min(2 * steps[-1], reach))
    return steps


def _window_pairs(length: int):
    """The windows of runs that can be met again, by the bytes they hold before the picked string, with two ranks each."""
    part = length - length // 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(2 * length)
        for batch in batches:
            held = []
            for key, high, some, least, most in zip(*(batch.column(c).to_pylist() for c in (
                    "id", "high", "content", "from", "upto")), strict=True):
                h = _hashes(np.frombuffer(some, np.uint8), part, powers).view(np.int64)
                before = np.arange(least, most + 1)
                i = high - before  # windows from the run's start
                held.append((np.full(len(i), key), before, h[i], h[i + length - part]))
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)],
                                                 names=["span", "i", "r1", "r2"])

    return emit


def _ranked(pairs: DataFrame) -> DataFrame:
    """``span``, ``i`` and the rank ``r`` of rank pairs that more than one position has, in the pairs' order.

    Pairs are counted in each task before they are dealt out, so one that a third of all positions share costs a row a
    task; the join back splits such a pair's positions over tasks.
    """
    met = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n")).filter("n > 1")
    ranks = met.sort("r1", "r2").select("r1", "r2", F.monotonically_increasing_id().alias("r"))
    return pairs.join(ranks, ["r1", "r2"]).select("span", "i", "r")


def _joined_up(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of positions, from rows sorted by span and position."""
    for batch in rows:
        span, i = batch.column("span").to_numpy(), batch.column("i").to_numpy()
        new = np.ones(len(i), bool)
        new[1:] = (span[1:] != span[:-1]) | (np.diff(i) != 1)
        at = np.flatnonzero(new)
        if len(at):
            last = np.append(at[1:], len(i)) - 1
            yield pa.RecordBatch.from_arrays([pa.array(span[at]), pa.array(i[at]), pa.array(i[last] + 1)],
                                             names=["id", "start", "stop"])


def repeats(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key``, ``start``, ``stop``: runs of positions in the distinct texts (``key``, ``text``) whose ``length`` bytes
    also start anywhere else, in the same text or another (or in a further row of the same text). Runs can touch.

    Rows with one key have one text. Runs of windows are dealt out by 64-bit hashes of the string they picked and told
    apart by digests; a run met again as a whole is done, and only runs whose picked string is met in different runs go on,
    one of equals. From that string they are ranked to the left and to the right by prefix doubling: a rank and the hash
    of the next piece, as long as all before it, make a pair; Spark sorts the pairs and gives new ranks to those met more
    than once, until a side is unique or past what a window can reach. The windows that both sides allow make a last
    pair, of their two halves, and those met more than once repeat.
    """
    runs = stored(texts.mapInArrow(_runs(length), "key binary, picked long, digest long, start long, stop long, place long"), "suffix-runs")
    # Written before they are joined, so that Spark can split the runs of a string that very many windows picked.
    classes = stored(runs.groupBy("picked").agg(F.count("*").alias("n"), F.min("digest").alias("a"), F.max("digest").alias("b"))
                     .filter("n > 1").select("picked", (F.col("a") != F.col("b")).alias("mixed")), "suffix-picked")
    met = stored(runs.join(classes, "picked").withColumn("id", F.monotonically_increasing_id()), "suffix-classes")
    discard(runs, classes)
    same = stored(met.groupBy("picked", "digest").agg(F.count("*").alias("n"), F.min("id").alias("one")), "suffix-same")
    known = stored(met.join(same, ["picked", "digest"]), "suffix-known")
    discard(met, same)
    whole = known.filter("n > 1").select("key", "start", "stop")

    # One run of equals is enough to go on.
    ones = known.filter("mixed and id = one").select(
        "key", F.struct("id", "picked", (F.col("n") > 1).alias("whole"), "start", "stop", "place").alias("run"))
    held = (texts.groupBy("key").agg(F.first("text").alias("text"))
            .join(ones.groupBy("key").agg(F.collect_list("run").alias("runs")), "key"))
    places = stored(held.select("text", "runs").mapInArrow(
        _places(length), "id long, picked long, whole boolean, low long, high long, before array<long>, "
                         "behind array<long>, content binary"), "suffix-places")
    near = stored(_met_windows(places, length), "suffix-near")
    pairs = stored(near.mapInArrow(_window_pairs(length), "span long, i long, r1 long, r2 long"), "suffix-pairs")
    discard(near)
    singles = places.filter("not whole").select(F.col("id").alias("span"), "high")
    last = (_ranked(pairs).select("span", "i").join(singles, "span").select("span", (F.col("high") - F.col("i")).alias("i"))
            .repartition("span").sortWithinPartitions("span", "i").mapInArrow(_joined_up, "id long, start long, stop long"))
    found = last.join(known.select("id", "key", F.col("start").alias("begin")), "id").select(
        "key", (F.col("begin") + F.col("start")).alias("start"), (F.col("begin") + F.col("stop")).alias("stop"))
    return whole.unionByName(found)


def _met_windows(places: DataFrame, length: int) -> DataFrame:
    """Runs with the windows (``from``, ``upto``: bytes before the picked string) whose bytes to both sides of it, as far
    as doubled steps tell, are met in another run of the same picked string."""
    reach = length - length // 2
    steps = _steps(reach)
    sides = places.select("id", "picked", F.explode(F.array(
        F.struct(F.lit("before").alias("side"), F.col("before").alias("names")),
        F.struct(F.lit("behind").alias("side"), F.col("behind").alias("names")))).alias("s"))
    sides = stored(sides.select(F.col("id").alias("span"), F.col("picked").alias("r1"),
                                (F.col("s.side") == "before").cast("long").alias("i"), "s.names"), "suffix-sides")
    alive, levels = sides, []
    for n in range(len(steps) - 1):
        # The side tells apart ranks of strings that grow to the left and to the right.
        pairs = alive.select("span", "i", "names", F.xxhash64("i", "r1").alias("r1") if n == 0 else "r1",
                             F.element_at("names", n + 1).alias("r2")).filter("r2 is not null")
        ranked = stored(_ranked(pairs).withColumnRenamed("r", "r1"), "suffix-ranks")
        levels.append(ranked.select("span", "i", F.lit(n + 1).alias("level")))
        alive = ranked.join(sides.drop("r1"), ["span", "i"])
    reached = levels[0]
    for level in levels[1:]:
        reached = reached.unionByName(level)
    # A side met up to one step and not to the next is met up to a byte before the next at most.
    bound = F.element_at(F.array(*[F.lit(x) for x in [*[step - 1 for step in steps[1:]], reach]]), F.col("level") + 1)
    bounds = reached.groupBy("span", "i").agg(F.max("level").alias("level")).select("span", "i", bound.alias("bound"))
    bounds = (bounds.groupBy("span").agg(F.max(F.when(F.col("i") == 1, F.col("bound"))).alias("before"),
                                         F.max(F.when(F.col("i") == 0, F.col("bound"))).alias("behind")))
    none = F.lit(steps[1] - 1)
    near = (places.drop("before", "behind").join(bounds.withColumnRenamed("span", "id"), "id", "left")
            .withColumn("from", F.greatest("low", reach - F.coalesce("behind", none)))
            .withColumn("upto", F.least("high", F.coalesce("before", none))).filter("from <= upto"))
    # A run known to be met as a whole is there for the others' sake: no further than they reach.
    wanted = (near.filter("not whole").groupBy("picked")
              .agg(F.min("from").alias("least"), F.max("upto").alias("most")))
    return (near.join(wanted, "picked").withColumn("from", F.when(F.col("whole"), F.greatest("from", "least")).otherwise(F.col("from")))
            .withColumn("upto", F.when(F.col("whole"), F.least("upto", "most")).otherwise(F.col("upto"))).filter("from <= upto")
            .select("id", "high", "content", "from", "upto"))


def _kept(id_type: str, length: int):
    """What is left of each text, from the runs of positions whose ``length`` bytes go."""

    def cut(text: bytes, windows: list[dict]) -> tuple[int, int, str]:
        parts, spans, removed, at = [], 0, 0, 0
        for start, stop in sorted((w["start"], w["stop"]) for w in windows):
            end = stop + length - 1
            if end <= at:
                continue
            if start > at or not spans:
                parts.append(text[at:start])
                spans, at = spans + 1, start
            removed, at = removed + end - at, end
        parts.append(text[at:])
        return removed, spans, hashlib.sha256(b"".join(parts)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            found = [cut(t, w or []) for t, w in zip(texts, batch.column("windows").to_pylist(), strict=True)]
            removed, spans, digests = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def windows(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """``key`` (MD5 of a text; null texts count as empty) and ``windows``, its repeated runs (start, stop) as ``repeats`` gives them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = repeats(docs.select(_key(text).alias("key"), text.alias("text")), length)
    return found.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("windows"))


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, bytes, bytes removed, maximal removed runs, and the SHA-256 of what is left, in hex.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else in the table, in the same text or another;
    strings are judged on the input, and never reach from one text into the next. So copies of a long text lose all of it, each
    of them. A null text is an empty one; shorter texts than ``length`` lose nothing; repeated rows are judged like other
    copies. Extra columns do not matter. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), _key(text).alias("key"))
    run, schema = _kept(dict(rows.dtypes)["id"], length)
    found = stored(windows(docs, length, text_col), "suffix-windows")
    return rows.join(found, "key", "left").select("id", "text", "windows").mapInArrow(run, schema).withColumnRenamed("id", id_col)
