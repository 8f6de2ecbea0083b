from decimal import Decimal, getcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstream.llm import vectors
from ledgerstream.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, rank string, score string, _part string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "r", "s", "p")
                                  for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    fine = {(i, tuple(np.float32(x) for x in v)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = []
    for i, q in fine:
        if i % every == 0:
            q = np.array(q, float)
            near = []
            for j, v in fine:
                if j != i:
                    v = np.array(v, float)
                    near.append((-(q @ v) / np.sqrt((q @ q) * (v @ v)), j))
            out += [(i, n, j, round(-s, 9)) for n, (s, j) in enumerate(sorted((round(s, 12), j) for s, j in near)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


def test_few_rows_like_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(25)]
    rows += [(50, None), (100, []), (150, [0, 0, 0, 0]), (200, [1, None, 2, 3]), (250, [float("nan"), 1, 1, 1]), (300, [float("inf"), 1, 1, 1]),
             (None, [1, 2, 3, 4]), (0, rows[0][1]), (400, [1, 2, 3]), (450, rows[0][1]), (500, rows[0][1])]
    expected = brute([r for r in rows if r[0] != 400])
    assert found(vectors.nearest(table(spark, rows), F.col("vec_id") % 50 == 0)) == expected


def test_hot_vector_like_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1, 2, 3] if i % 3 else rng.normal(size=3).round(1).tolist()) for i in range(400)]
    assert found(vectors.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, recall=1.0)) == brute(rows)


def test_chunks_lose_nothing(monkeypatch, spark):
    monkeypatch.setattr(vectors, "BASE_ROWS", 40)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 3)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(500)]
    assert found(vectors.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, parts=1)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny_tables(spark, n):
    rows = [(i * 50, [1.0, i]) for i in range(n)]
    assert found(vectors.nearest(table(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows)


def test_parts_are_balanced_and_local():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    points = centres[rng.integers(0, 12, 3000)] + 0.2 * rng.normal(size=(3000, 16))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    graph = vectors.neighbour_graph(unit, 10)
    part = vectors.balanced_parts(unit, graph, 12)
    sizes = np.bincount(part, minlength=12)
    assert sizes.max() <= np.ceil(3000 / 12 * 1.05) + 1
    assert (part[graph] == part[:, None]).mean() > 0.5


def test_recall_on_the_table(spark, sf_dir):
    df = QUERIES["op5_learned_partitions"](spark, sf_dir)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    truth, held = brute(rows), found(df)
    assert len({(q, v) for q, _, v, _ in truth} & {(q, v) for q, _, v, _ in held}) >= 0.9 * len(truth) > 0


def test_ties_beyond_the_product_keep_the_smallest_ids():
    import pandas as pd
    # Copies of one direction at other lengths, powers of two: their exact scores are equal.
    base = pd.DataFrame({"_key": range(40), "_vec": [[3.0 * 2 ** (i % 20), 4.0 * 2 ** (i % 20)] for i in range(40)]}).iloc[::-1]
    found = vectors._compare(base, pd.DataFrame({"_key": [99], "_vec": [[3.0, 4.0]]}), 6)
    assert found["_rep"].tolist() == list(range(6)) and found["_query"].tolist() == [99] * 6


def test_magnitudes_that_squares_cannot_hold(spark):
    """Against exact arithmetic: finite components of any size, and lengths far apart."""
    getcontext().prec = 60
    given = {0: [1e200, 1e200], 1: [1e200, 0.0], 2: [1e-200, 1e-201], 3: [3.0, 4.0], 4: [-1e308, 1e300], 5: [5e-324, 5e-324],
             6: [1e155, -1e150], 50: [1e-300, 1.5e-299]}

    def cosine(a, b):
        a, b = ([Decimal(x) for x in v] for v in (a, b))
        dot = lambda x, y: sum(p * q for p, q in zip(x, y))
        return dot(a, b) / (dot(a, a).sqrt() * dot(b, b).sqrt())

    table = spark.createDataFrame(list(given.items()), "vec_id bigint, embedding array<double>")
    found = vectors.nearest(table, F.col("vec_id") % 50 == 0).collect()
    for q in (0, 50):
        rows = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        expected = sorted((-cosine(given[q], v), i) for i, v in given.items() if i != q)[:5]
        assert [i for _, i, _ in rows] == [i for _, i in expected]
        assert all(abs(s + float(c)) < 1e-15 for (_, _, s), (c, _) in zip(rows, expected))


def test_clashing_columns_do_not_matter(spark):
    plain = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)], "vec_id bigint, embedding array<double>")
    clashing = plain.selectExpr("*", *[f"'x' as {c}" for c in ("query_id", "rank", "score", "_part", "_key", "_vec", "_id", "_n", "_rep")])
    one, other = (sorted(map(tuple, vectors.nearest(t, F.col("vec_id") % 50 == 0).collect())) for t in (plain, clashing))
    assert one == other and len(one) == 10
