"""Approximate nearest neighbours by learned partitions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstream.llm.common import stored

MARGIN = 1e-12  # the product's last digits may differ from the exact score's
PAIRS = 1 << 14  # pairs that are scored exactly at once
SAMPLE = 8192  # vectors that the partitions are learned from, at most
TESTED = 512  # of them, vectors whose neighbours tell how many partitions to probe
NEIGHBOURS = 10  # of each vector in the graph
HIDDEN = 64
SLACK = 0.05  # a part of the graph may be so much above the mean
BASE_ROWS, QUERY_ROWS = 4096, 2048  # about as many vectors and queries are compared at a time


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` nearest others of each row, in blocks."""
    k = min(k, len(unit) - 1)
    out = np.empty((len(unit), k), np.int64)
    for at in range(0, len(unit), 1024):
        near = unit[at:at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at:at + 1024] = np.argsort(-near, axis=1, kind="stable")[:, :k]
    return out


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each vertex, of nearly equal sizes and few cut edges.

    Halves along principal directions give the start; then vertices move to the part that most of their neighbours
    are in, those that gain most first, as long as that part has room.
    """
    part = np.zeros(len(unit), np.int64)
    pieces = [(np.arange(len(unit)), parts, 0)]
    while pieces:
        rows, n, first = pieces.pop()
        if n == 1:
            part[rows] = first
            continue
        some = unit[rows] - unit[rows].mean(0)
        axis = np.linalg.svd(some[:: max(len(some) // 1024, 1)], full_matrices=False)[2][0]
        order = rows[np.argsort(some @ axis, kind="stable")]
        cut = len(rows) * (n // 2) // n
        pieces += [(order[:cut], n // 2, first), (order[cut:], n - n // 2, first + n // 2)]
    room = int(np.ceil(len(unit) / parts * (1 + SLACK)))
    for _ in range(rounds):
        votes = np.zeros((len(unit), parts))
        np.add.at(votes, (np.repeat(np.arange(len(unit)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(unit)), best] - votes[np.arange(len(unit)), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < room:
                sizes[part[v]] -= 1
                sizes[best[v]] += 1
                part[v], moved = best[v], moved + 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A small network that gives each vector the probabilities of the partitions."""

    weights: list[np.ndarray]
    probes: int

    def probabilities(self, unit: np.ndarray) -> np.ndarray:
        first, bias, second, offset = self.weights
        return _softmax(np.maximum(unit @ first + bias, 0) @ second + offset)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _train(unit: np.ndarray, target: np.ndarray, epochs: int = 30, batch: int = 256, rate: float = 3e-3) -> list[np.ndarray]:
    rng = np.random.default_rng(5)
    sizes = [(unit.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, target.shape[1]), (target.shape[1],)]
    weights = [rng.normal(0, np.sqrt(2 / s[0]), s) if len(s) == 2 else np.zeros(s) for s in sizes]
    mean, square, step = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes], 0
    for _ in range(epochs):
        order = rng.permutation(len(unit))
        for at in range(0, len(order), batch):
            x, y = unit[order[at:at + batch]], target[order[at:at + batch]]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            wrong = (_softmax(hidden @ weights[2] + weights[3]) - y) / len(x)
            back = (wrong @ weights[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((x.T @ back, back.sum(0), hidden.T @ wrong, wrong.sum(0))):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                weights[i] -= rate * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return weights


def fit(unit: np.ndarray, parts: int, recall: float, k: int) -> Router:
    """Learns the router from a sample; probes as many partitions as its own neighbours need for ``recall``."""
    parts = max(1, min(parts, len(unit) // 32))
    if parts == 1:
        return Router([np.zeros((unit.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    graph = neighbour_graph(unit, NEIGHBOURS)
    part = balanced_parts(unit, graph, parts)
    # A vector's target is where it and its neighbours are.
    target = np.zeros((len(unit), parts))
    around = np.column_stack([np.arange(len(unit)), graph])
    np.add.at(target, (np.repeat(np.arange(len(unit)), around.shape[1]), part[around].ravel()), 1)
    router = Router(_train(unit, target / target.sum(1, keepdims=True)), parts)
    likely = router.probabilities(unit)
    place = likely.argmax(1)
    asked = np.arange(0, len(unit), max(len(unit) // TESTED, 1))
    ranks = np.argsort(np.argsort(-likely[asked], axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.sort(ranks[np.arange(len(asked))[:, None], place[graph[asked][:, :k]]].ravel())
    router.probes = int(needed[min(int(np.ceil(recall * len(needed))), len(needed) - 1)]) + 1
    return router


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id`` and ``_vec`` (doubles) of the rows that can be compared."""
    values = F.col(vec_col).cast("array<double>")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(values, lambda x: x != 0)
    return vectors.filter(F.col(id_col).isNotNull() & fine).select(F.col(id_col).alias("_id"), values.alias("_vec"))


def _matrix(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Vectors brought near 1 by a power of two, which changes no digit of a cosine, and of length 1."""
    values = np.stack(vectors.to_list())
    scaled = np.ldexp(values, -np.frexp(np.abs(values).max(1, keepdims=True))[1])
    return scaled, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, parts: int = 32, recall: float = 0.97,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest cosine for each row that ``queries`` holds for, other than that row itself.

    Partitions are learned from at most ``SAMPLE`` rows (those of smallest hash): their neighbour graph is cut into
    balanced parts, and a small network learns where a vector and its neighbours are. Every row goes to its most
    probable partition; a query goes to its most probable ones, as many as the sample's own neighbours need for
    ``recall``, and is compared there with all rows by exact cosines in double precision. A large partition is compared
    in chunks, so that no task holds more than a few thousand vectors.

    Equal vectors are compared once: of each the ``k + 1`` smallest ids are kept, which is all that a result can hold.

    Returns ``query_id``, ``rank`` (from 1; ties to the smaller id), ``vec_id`` and ``score``. Vectors that are null,
    empty, zero or hold a null or a number that isn't finite take no part, and neither do rows without an id, nor vectors of
    another length than most. Equal rows count once. With fewer rows than ``k`` all are returned.
    """
    usable = _usable(vectors, id_col, vec_col)
    lengths = usable.groupBy(F.size("_vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = lengths.n if lengths else 0
    usable = usable.filter(F.size("_vec") == length)
    asked = _usable(vectors.filter(queries), id_col, vec_col).filter(F.size("_vec") == length).distinct()

    first = Window.partitionBy("_vec").orderBy("_id")
    distinct = stored(usable.distinct().withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k + 1)
                      .groupBy("_vec").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))  # k + 1 at most
                      .withColumn("_rep", F.col("_ids")[0]), "vector-distinct")
    hashed = F.xxhash64("_rep")
    lowest = distinct.select(hashed.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]  # hashes only
    sample = (distinct.filter(hashed <= F.lit(lowest)).select("_rep", "_vec").limit(SAMPLE).toPandas()
              .sort_values("_rep")["_vec"])
    router = fit(_matrix(sample)[1], parts, recall, k) if len(sample) else fit(np.zeros((0, 1)), 1, recall, k)

    placed = stored(_routed(distinct.select(F.col("_rep").alias("_key"), "_vec"), router, 1), "vector-parts")
    probing = stored(_routed(asked.select(F.col("_id").alias("_key"), "_vec"), router, router.probes), "vector-probes")
    chunks = stored(_chunks(placed, BASE_ROWS, "_chunks").join(_chunks(probing, QUERY_ROWS, "_blocks"), "_part"),
                    "vector-chunks")  # one row for each partition
    key = ["_part", "_chunk", "_block"]
    own = lambda n: F.pmod(F.xxhash64("_key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    base = placed.join(chunks, "_part").select(
        "_part", own("_chunks").alias("_chunk"), every("_blocks").alias("_block"), "_key", "_vec")
    sought = probing.join(chunks, "_part").select(
        "_part", own("_blocks").alias("_block"), every("_chunks").alias("_chunk"), "_key", "_vec")
    found = base.groupBy(*key).cogroup(sought.groupBy(*key)).applyInPandas(
        lambda b, q: _compare(b, q, k + 1), "_query bigint, _rep bigint, score double")
    best = Window.partitionBy("_query").orderBy(F.desc("score"), "_rep")
    kept = found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1)
    ids = kept.join(distinct.select("_rep", "_ids"), "_rep").select(
        F.col("_query").alias("query_id"), F.explode("_ids").alias("vec_id"), "score").filter("vec_id != query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (ids.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _routed(rows: DataFrame, router: Router, probes: int) -> DataFrame:
    """``rows`` with a row for each of their most probable partitions."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                likely = router.probabilities(_matrix(batch["_vec"])[1])
                order = np.argsort(-likely, axis=1, kind="stable")[:, :probes]
                yield batch.assign(_parts=list(order.astype(np.int32)))

    return (rows.mapInPandas(route, "_key bigint, _vec array<double>, _parts array<int>")
            .select(F.explode("_parts").alias("_part"), "_key", "_vec"))


def _chunks(rows: DataFrame, size: int, name: str) -> DataFrame:
    return rows.groupBy("_part").agg(F.ceil(F.count("*") / size).alias(name))


def _compare(base: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of the base for each query."""
    if not len(base) or not len(queries):
        return pd.DataFrame({"_query": [], "_rep": [], "score": []}).astype({"_query": "int64", "_rep": "int64"})
    (values, unit), (asked, asked_unit) = _matrix(base["_vec"]), _matrix(queries["_vec"])
    reps, out = base["_key"].to_numpy(), []
    few = min(len(base), k)
    for at in range(0, len(asked), 512):
        near = asked_unit[at:at + 512] @ unit.T
        least = np.partition(near, len(base) - few, axis=1)[:, len(base) - few]
        rows, picks = np.nonzero(near >= least[:, None] - MARGIN)
        scores = np.empty(len(rows))
        for i in range(0, len(rows), PAIRS):
            q, v = asked[at + rows[i:i + PAIRS]], values[picks[i:i + PAIRS]]
            scores[i:i + PAIRS] = (q * v).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((v * v).sum(1)))
        order = np.lexsort((reps[picks], -scores, rows))
        firsts = np.searchsorted(rows, np.arange(len(near)))  # the rows are in order already
        order = order[np.arange(len(rows)) - firsts[rows] < k]
        out.append(pd.DataFrame({"_query": queries["_key"].to_numpy()[at + rows[order]],
                                 "_rep": reps[picks[order]], "score": scores[order]}))
    return pd.concat(out)
