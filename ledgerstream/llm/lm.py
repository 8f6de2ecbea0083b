"""Log-likelihood of whole documents: a recurrent language model beside a smoothed unigram."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstream.llm.common import slices, stored
from ledgerstream.llm.gru import END, Model, Trainer

KNOWN = 1 << 18  # words, the most frequent, whose counts are sent to every task; the others' are joined
SYMBOLS = 1024  # of the recurrent model: the end, the most frequent words, and one for all others
WARM = 256  # texts that the first model is fitted to
BESIDE = 384  # streams of texts that run side by side when the model is trained further
ROUNDS = 2  # of training, each over a part of the texts, with the tasks' models averaged after it
LEARNT = 1 << 19  # tokens that a task trains on in a round, at least
SUMS = 16  # partitions that add the tasks' weights up
HELD = 1 << 19  # words a task counts before it hands them on
ROWS, CHARS = 16384, 48 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII letters and white space


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over the column ``text``, counted in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def batch() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()),
                                                pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return found

        for given in batches:
            for text in given.column("text"):
                held.update(words_of(text.as_py()))
                if len(held) > HELD:
                    yield batch()
        if held:
            yield batch()

    return texts.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = KNOWN) -> list[tuple[str, int]]:
    """The most frequent words, by count and name: all from a count on that at most ``most`` words reach."""
    step = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect()  # a few hundred rows
    held, least = 0, None
    for row in steps:
        held += row["count"]
        if held > most:
            break
        least = row.s
    if least is None:
        return []
    return sorted(((r.word, r.n) for r in counts.filter(step >= least).collect()), key=lambda x: (-x[1], x[0]))


class Vocabulary:
    """Ids of the known words, their counts, and their symbols in the recurrent model."""

    def __init__(self, known: list[tuple[str, int]], texts: int, total: int, distinct: int):
        self.words = [w.encode() for w, _ in known]
        self.texts, self.counts = texts, np.array([n for _, n in known], np.int64)
        # The end of a text is a token of its own.
        self.total, self.distinct = total + texts, distinct + (texts > 0)
        own = min(SYMBOLS - 2, len(known))
        self.rest_total, self.rest_distinct = total - int(self.counts[:own].sum()), distinct - own
        self.other = own + 1
        self.symbols = np.full(len(known) + 1, self.other, np.int32)  # the last stands for words not known
        self.symbols[:own] = np.arange(1, own + 1)
        self.symbol_counts = np.array([texts, *self.counts[:own], self.rest_total], float)
        smoothed = np.log10(self.counts + 1.0)
        self.base = np.append(smoothed - math.log10(self.total + self.distinct + 1), 0.0)
        self.base_end = math.log10((texts + 1) / (self.total + self.distinct + 1))
        self.rest = np.append(np.where(np.arange(len(known)) < own, 0.0,
                                       smoothed - math.log10(self.rest_total + self.rest_distinct + 1)), 0.0)

    def own(self) -> dict[bytes, int]:
        """The symbols of the words that have one of their own."""
        return {w: i for i, w in enumerate(self.words[:self.other - 1], 1)}

    def ids(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


def _symbols(own: dict[bytes, int], vocabulary: Vocabulary, text: str | None) -> np.ndarray:
    words = words_of(text)
    found = np.fromiter(map(own.get, words, repeat(vocabulary.other)), np.int32, len(words))
    return np.append(found, np.int32(END))


def fit(texts: DataFrame, vocabulary: Vocabulary) -> Model:
    """Trains the recurrent model.

    A few texts (``WARM``, of smallest hash) give a first model. Then all training texts, whole ones, are dealt into
    ``ROUNDS`` parts by hash. In a round each task trains the model further over its texts of that part, by truncated
    backpropagation and with moments that last through its batches, and the tasks' weights are averaged by the tokens they
    saw: added up in ``SUMS`` partitions, so that the driver gets as many rows however many tasks there are. A task
    holds the symbols of one batch of rows only.
    """
    own = vocabulary.own()
    hashed = texts.select("text", F.xxhash64("_id", "text").alias("h"))
    lowest = hashed.select("h").orderBy("h").limit(WARM).agg(F.max("h")).first()[0]  # hashes only meet in one place
    warm = hashed.filter(F.col("h") <= F.lit(lowest)).limit(WARM).collect() if lowest is not None else []
    model = Model.new(vocabulary.symbol_counts)
    model, _ = model.train([_symbols(own, vocabulary, r.text) for r in sorted(warm, key=lambda r: (r.h, r.text or ""))])
    # With too few texts a task's model would hardly leave the one it starts from, so small inputs have few learners.
    learners = max(1, vocabulary.total // (ROUNDS * LEARNT))
    for turn in range(ROUNDS):
        part = hashed.filter(F.pmod("h", F.lit(ROUNDS)) == turn).select("text").coalesce(learners)
        trained = part.mapInPandas(_further(vocabulary, model), "tokens bigint, weights binary")
        sums = trained.repartition(SUMS).mapInPandas(_summed, "tokens bigint, weights binary").collect()
        tokens = sum(r.tokens for r in sums)
        if tokens:
            model = model.with_flat(sum(np.frombuffer(r.weights) for r in sums) / tokens)
    return model


def _further(vocabulary: Vocabulary, model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, trainer, total = vocabulary.own(), Trainer(model), 0
        for batch in batches:
            for _, texts in slices([t or "" for t in batch["text"]], ROWS, CHARS):
                total += trainer.feed([_symbols(own, vocabulary, t) for t in texts], BESIDE)
        if total:
            weights = trainer.values.astype(np.float64) * total
            yield pd.DataFrame({"tokens": [total], "weights": [weights.tobytes()]})

    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tokens, weights = 0, 0.0
    for batch in batches:
        tokens += int(batch["tokens"].sum())
        for row in batch["weights"]:
            weights = weights + np.frombuffer(row)
    if tokens:
        yield pd.DataFrame({"tokens": [tokens], "weights": [weights.tobytes()]})


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, token counts and the two log10 probabilities of each whole text.

    A-Z are lower-cased, words split at ASCII white space, and each text has an end as its last token. Counts come from
    all texts that are not held out: ``train_tokens`` (N), each token's count c and the number of distinct tokens V.
    ``base_score`` is the sum of log10((c + 1) / (N + V + 1)); ``n_known`` counts the tokens with c above 0.

    ``score`` is the recurrent model's: a gated recurrent unit with a class-factored output reads the text from start to
    end, its state carried on, over the most frequent words, the end and one symbol for all other words; such a word's own
    probability is that symbol's times its smoothed part of the words it stands for.

    The counts of the most frequent words go to every task, a list of bounded length; those of all others are joined, so
    a word that is everywhere meets no join. A null text is an empty one, which has its end only. Equal rows are
    scored each; where nothing is left to train on, counts are 0 and the model is uniform.
    """
    rows = docs.select(F.col(id_col).alias("_id"), held_out.alias("_held"), F.col(text_col).alias("text"))
    training = rows.filter("not _held")
    counts = stored(word_counts(training), "lm-counts")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    vocabulary = Vocabulary(frequent(counts), training.count(), whole.total, whole.distinct)
    model = fit(training, vocabulary)
    schema = ("_id " + dict(rows.dtypes)["_id"] + ", _held boolean, _tokens bigint, _known bigint, _base double, "
              "_score double, _words array<string>, _ns array<bigint>")
    scored = stored(rows.mapInArrow(_scorer(vocabulary, model), schema)
                    .withColumn("_row", F.monotonically_increasing_id()), "lm-scored")
    all_tokens, rest = vocabulary.total + vocabulary.distinct + 1, vocabulary.rest_total + vocabulary.rest_distinct + 1
    c = F.coalesce(counts["n"], F.lit(0))
    sums = (scored.select("_row", F.explode(F.arrays_zip("_words", "_ns")).alias("_w"))
            .select("_row", F.col("_w._words").alias("word"), F.col("_w._ns").alias("_n")).join(counts, "word", "left")
            .groupBy("_row").agg(
                F.sum(F.when(c > 0, F.col("_n")).otherwise(0)).alias("_more_known"),
                F.sum(F.col("_n") * F.log10((c + 1) / F.lit(float(all_tokens)))).alias("_more_base"),
                F.sum(F.col("_n") * F.log10((c + 1) / F.lit(float(rest)))).alias("_more_score")))
    return scored.join(sums, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), F.col("_tokens").alias("n_tokens"),
        (F.col("_known") + F.coalesce("_more_known", F.lit(0))).alias("n_known"),
        F.lit(int(vocabulary.total)).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more_base", F.lit(0.0))).alias("base_score"),
        (F.col("_score") + F.coalesce("_more_score", F.lit(0.0))).alias("score"))


def _scorer(vocabulary: Vocabulary, model: Model):
    """Scores texts but for their words that are not known, which it lists with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = vocabulary.ids()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, some in slices(texts, ROWS, CHARS):
                yield part(ids, batch.slice(first, len(some)), some)

    def part(ids: dict[bytes, int], given: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        found, words, ns, offsets = [], [], [], [0]
        for text in texts:
            split = words_of(text)
            row = np.fromiter(map(ids.get, split, repeat(-1)), np.int32, len(split))
            rare = Counter(compress(split, (row < 0).tolist()))
            words += rare.keys()
            ns += rare.values()
            offsets.append(len(words))
            found.append(row)
        lengths = np.array([len(r) for r in found])
        flat = np.concatenate(found)
        owner = np.repeat(np.arange(len(found)), lengths)
        summed = lambda values: np.bincount(owner, values, len(found))
        ends = np.cumsum(lengths)
        tokens = np.insert(vocabulary.symbols[flat], ends, END)
        scores = model.score(tokens, lengths + 1) + summed(vocabulary.rest[flat])
        known = summed((flat >= 0).astype(float)).astype(np.int64) + int(vocabulary.texts > 0)
        offsets = pa.array(offsets, pa.int32())
        return pa.RecordBatch.from_arrays([
            given.column("_id"), given.column("_held"), pa.array(lengths + 1, pa.int64()), pa.array(known),
            pa.array(summed(vocabulary.base[flat]) + vocabulary.base_end), pa.array(scores),
            pa.ListArray.from_arrays(offsets, pa.array(words, pa.binary()).cast(pa.string())),
            pa.ListArray.from_arrays(offsets, pa.array(ns, pa.int64()))],
            names=["_id", "_held", "_tokens", "_known", "_base", "_score", "_words", "_ns"])

    return run
