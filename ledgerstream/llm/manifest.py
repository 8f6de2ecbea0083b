"""A Merkle manifest of a table: leaves by row, a tree for each source, and one tree over the sources' roots.

The trees are persistent: a changed leaf makes a version of its tree that copies the leaf's ancestors only and shares
every other node. Trees are cut into aligned blocks of ``FAN ** HEIGHT`` nodes; a block is one task's work, and blocks'
roots are the leaves of the next blocks above, so no task holds more than one block, whatever a source's share of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstream.llm.common import discard, free_name, stored

FAN, HEIGHT = 3, 7
BLOCK = FAN ** HEIGHT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<slot: int, siblings: array<string>>>"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """The original nodes of a block, by level; versions share them and hold only what they copy."""

    def __init__(self, leaves: list[str], height: int | None):
        """``height``: levels above the leaves; None: up to a single node."""
        self.levels = [leaves]
        while len(self.levels) <= height if height is not None else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([digest(below[i:i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, leaf: int) -> list[tuple[int, list[str]]]:
        """Per level, from the leaf up: the node's slot in its run, and the run's other nodes."""
        steps = []
        for nodes in self.levels[:-1]:
            start = leaf - leaf % FAN
            steps.append((leaf - start, nodes[start:leaf] + nodes[leaf + 1:start + FAN]))
            leaf //= FAN
        return steps


def copied(path: list[tuple[int, list[str]]], changed: str) -> list[str]:
    """The nodes of a version: the changed leaf and its copied ancestors; all siblings are the original's."""
    nodes = [changed]
    for slot, siblings in path:
        nodes.append(digest([*siblings[:slot], nodes[-1], *siblings[slot:]]))
    return nodes


def field(name: str) -> Column:
    """A value as ``bytes:value``, or ``-`` for null."""
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*values), 256)


def tampered(doc_id: str = "doc_id") -> Column:
    """The rows to tamper with: even CRC-32 of the decimal id. A row without an id stays."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 2 == 0, F.lit(False))


def _numbered(nodes: DataFrame, name: str, *keys: str) -> DataFrame:
    """``_place`` of each row in its ``_group`` by ``keys``, from 0, and ``_n``, the group's rows.

    Rows are dealt out by ranges of (group, keys), so a group that holds a third of all rows spreads over many ranges;
    places start from the sum of the ranges before.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    laid = stored(nodes.repartitionByRange(F.col("_group"), *order).withColumn("_range", F.spark_partition_id()), name)
    parts = laid.groupBy("_group", "_range").agg(F.count("*").alias("_rows"))  # a row for each range and group in it
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_group", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
                         F.sum("_rows").over(Window.partitionBy("_group")).alias("_n"))
    nth = F.row_number().over(Window.partitionBy("_group", "_range").orderBy(*order))
    placed = stored(laid.withColumn("_nth", nth).join(parts, ["_group", "_range"])
                    .withColumn("_place", F.col("_before") + F.col("_nth") - 1)
                    .drop("_range", "_nth", "_before"), name)
    discard(laid)
    return placed


def _block(place: str = "_place") -> Column:
    return F.floor(F.col(place) / BLOCK).alias("_block")


def _height(n: int) -> int | None:
    """Levels a block rises: to its own top, where it is all there is."""
    return HEIGHT if n > BLOCK else None


def _paths(nodes: DataFrame, name: str) -> DataFrame:
    """``_group``, ``_place``, ``_path`` (to the group's root) and ``_root`` for nodes with ``_digest`` and ``_n``."""

    def inner(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place")
        tree = Tree(rows["_digest"].tolist(), _height(int(rows["_n"].iloc[0])))
        return pd.DataFrame({"_group": rows["_group"], "_place": rows["_place"], "_block": rows["_block"],
                             "_inner": [_packed(tree.path(i)) for i in range(len(rows))], "_top": tree.root})

    found = stored(nodes.select("_group", "_place", "_digest", "_n", _block()).groupBy("_group", "_block").applyInPandas(
        inner, f"_group string, _place long, _block long, _inner {PATH}, _top string"), name)
    if (nodes.agg(F.max("_n")).first()[0] or 0) <= BLOCK:
        return found.select("_group", "_place", F.col("_inner").alias("_path"), F.col("_top").alias("_root"))
    above = _paths(_tops(found, nodes), name).withColumnRenamed("_place", "_block")
    return found.join(above, ["_group", "_block"]).select(
        "_group", "_place", F.concat("_inner", "_path").alias("_path"), "_root")


def _tops(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """The blocks' roots as the nodes of the next blocks above."""
    counts = nodes.select("_group", F.ceil(F.col("_n") / BLOCK).alias("_n")).distinct()
    return (found.groupBy("_group", F.col("_block").alias("_place")).agg(F.first("_top").alias("_digest"))
            .join(counts, "_group"))


def _packed(path: list[tuple[int, list[str]]]) -> list[dict]:
    return [{"slot": slot, "siblings": siblings} for slot, siblings in path]


def _unpacked(path) -> list[tuple[int, list[str]]]:
    return [(int(step["slot"]), list(step["siblings"])) for step in path]


def _roots(leaves: DataFrame) -> DataFrame:
    """``_group``, ``_place``, ``_digest``, ``_n`` of the leaf blocks' roots, as nodes above the leaves."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["_n"].iloc[0])
        tree = Tree(rows.sort_values("_place")["_leaf"].tolist(), _height(n))
        return pd.DataFrame({"_group": [key[0]], "_place": [key[1]], "_digest": [tree.root], "_n": [-(-n // BLOCK)]})

    return leaves.select("_group", "_place", "_leaf", "_n", _block()).groupBy("_group", "_block").applyInPandas(
        top, "_group string, _place long, _digest string, _n long")


def _walk(docs: DataFrame, id_col: str, columns: tuple[str, ...], group_col: str, text_col: str, changed: Column,
          block: Callable[[Tree, list, pd.DataFrame], Iterator[dict]], schema: str) -> DataFrame:
    """Builds the trees and gives each leaf block, its rows and its way up to ``block``."""
    deletes = F.replace(F.col(text_col), F.lit("\n"), F.lit(""))
    kept = free_name(docs, "_deleted")
    rows = docs.withColumn(kept, deletes)
    leaves = _numbered(rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("_group"),
        F.col(id_col).alias("_id"), leaf_of(*[field(c) for c in columns]).alias("_leaf"),
        F.when(changed, leaf_of(*[field(kept if c == text_col else c) for c in columns])).alias("_changed")),
        "manifest-leaves", "_id", "_leaf", "_changed")
    tops = stored(_roots(leaves), "manifest-roots")
    within = _paths(tops, "manifest-paths")
    subroots = stored(within.groupBy("_group").agg(F.first("_root").alias("_digest")), "manifest-subroots")
    order = _numbered(subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_source"), "_digest"),
                      "manifest-sources", "_source")
    over = (order.select("_source", "_place", F.col("_digest").alias("_subroot"))
            .join(_paths(order, "manifest-top").drop("_group"), "_place")
            .select(F.col("_source").alias("_group"), "_subroot", F.col("_path").alias("_over"), "_root"))
    ways = (within.select("_group", F.col("_place").alias("_block"), "_path").join(over, "_group")
            .select("_group", "_block", F.concat("_path", "_over").alias("_path"), "_subroot", "_root"))

    def along(key: tuple, rows: pd.DataFrame, way: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place")
        tree, step = Tree(rows["_leaf"].tolist(), _height(int(rows["_n"].iloc[0]))), way.iloc[0]
        upper = _unpacked(step["_path"])
        found = [{"_subroot": step["_subroot"], "_root": step["_root"], **out}
                 for out in block(tree, upper, rows)]
        return pd.DataFrame(found, columns=names)

    schema = schema.replace("_id any", "_id " + dict(leaves.dtypes)["_id"])
    names = [c.split()[0] for c in schema.split(", ")]
    return (leaves.select("*", _block()).groupBy("_group", "_block")
            .cogroup(ways.groupBy("_group", "_block")).applyInPandas(along, schema))


def _proofs(tree: Tree, upper: list, rows: pd.DataFrame) -> Iterator[dict]:
    for i, (key, leaf, changed) in enumerate(zip(rows["_id"], rows["_leaf"], rows["_changed"], strict=True)):
        path = tree.path(i) + upper
        yield {"_id": key, "_leaf": leaf, "_proof": digest([s for _, siblings in path for s in siblings]),
               "_folded": copied(path, leaf if changed is None else changed)[-1]}


def _versions(tree: Tree, upper: list, rows: pd.DataFrame) -> Iterator[dict]:
    places = rows["_place"].tolist()
    for i, (key, leaf, changed) in enumerate(zip(rows["_id"], rows["_leaf"], rows["_changed"], strict=True)):
        if changed is not None and changed != leaf:
            for level, node in enumerate(copied(tree.path(i) + upper, changed)):
                yield {"_id": key, "_group": rows["_group"].iloc[0], "_place": places[i], "_level": level, "_node": node}


def manifest(docs: DataFrame, changed: Column, id_col: str = "doc_id", columns: tuple[str, ...] = COLUMNS,
             group_col: str = "source", text_col: str = "text") -> DataFrame:
    """Each row's leaf, its proof, and whether the row verifies once rows where ``changed`` holds lose their newlines.

    A leaf hashes the values of ``columns``, each as its byte length, ``:`` and the value, or ``-`` for null. Per value
    of ``group_col`` leaves ascend by id (nulls first, then by digest: equal rows have equal leaves, and which of them
    stands first changes nothing but their proofs), and every ``FAN`` nodes give one, until one is left: ``subroot``.
    Subroots, by group in byte order and null first, give ``root`` likewise. ``proof_sha256`` hashes a leaf's siblings
    up to the root. ``folded_root`` is the root of the version that the row makes: its changed leaf (or its own) and
    copies of its ancestors, all else the original tree; ``verified`` tells whether it equals ``root``.

    Texts are hashed where they are read and never moved. A null or empty text cannot change. A single row is its own
    subroot. Extra columns do not matter. An empty table gives no rows.
    """
    found = _walk(docs, id_col, columns, group_col, text_col, changed, _proofs,
                  "_id any, _leaf string, _subroot string, _root string, _proof string, _folded string")
    return found.select(
        F.col("_id").alias(id_col), F.col("_leaf").alias("leaf"), F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"), F.col("_proof").alias("proof_sha256"), F.col("_folded").alias("folded_root"),
        (F.col("_folded") == F.col("_root")).alias("verified"))


def versions(docs: DataFrame, changed: Column, id_col: str = "doc_id", columns: tuple[str, ...] = COLUMNS,
             group_col: str = "source", text_col: str = "text") -> DataFrame:
    """The nodes that changed rows' versions copy: id, group, the leaf's place, level (0: the leaf), digest.

    All other nodes of a version are those of the original trees. Rows that do not change have no version.
    """
    found = _walk(docs, id_col, columns, group_col, text_col, changed, _versions,
                  "_id any, _group string, _place long, _level int, _node string")
    return found.select(F.col("_id").alias(id_col), F.expr("if(_group = '0', null, substr(_group, 2))").alias(group_col),
                        F.col("_place").alias("place"), F.col("_level").alias("level"), F.col("_node").alias("node"))
