"""Collision counting against every distance."""

import math

import numpy as np
import pandas as pd
import pytest

from wardloom.llm import collision
from wardloom.llm.collision import Search, nearest_neighbours, recall, threshold


def _exact(ids, vectors, search):
    rows = []
    for i, v in zip(ids, vectors):
        if i % search.every == 0:
            away = np.sqrt(((vectors - v) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, away)) if ids[j] != i][: search.k]
            rows += [(i, r, ids[j], away[j]) for r, j in enumerate(order, 1)]
    return pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"])


def _table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("made", ["random", "clusters", "line", "plane", "scaled"])
def test_recall_in_many_blocks(spark, made):
    rng = np.random.default_rng(3)
    n = 3000
    vectors = {
        "random": lambda: rng.standard_normal((n, 32)),
        "clusters": lambda: rng.standard_normal((40, 32))[rng.integers(0, 40, n)] * 10 + rng.standard_normal((n, 32)),
        "line": lambda: rng.standard_normal((n, 1)),
        "plane": lambda: rng.random((n, 2)),
        "scaled": lambda: rng.standard_normal((n, 8)) * np.exp(rng.uniform(-20, 20, (n, 1))),
    }[made]()
    ids, search = np.arange(n), Search(row_block=300, query_block=10, cells=6)
    found = nearest_neighbours(_table(spark, ids, vectors), search=search).toPandas()
    exact = _exact(ids, vectors, search)
    assert found.groupby("query_id").size().tolist() == [10] * 30
    assert recall(found, exact) >= 0.9
    away = {(q, v): np.sqrt(((vectors[q] - vectors[v]) ** 2).sum()) for q, v in zip(found["query_id"], found["vec_id"])}
    assert all(math.isclose(away[q, v], s, rel_tol=1e-12) for q, v, s in zip(found["query_id"], found["vec_id"], found["score"]))
    ordered = found.sort_values(["query_id", "rank"])
    assert (ordered.sort_values(["query_id", "score", "vec_id"], kind="stable").index == ordered.index).all()


def test_recall_on_the_given_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").toPandas()
    vectors = np.stack(rows["embedding"]).astype(np.float64)
    found = nearest_neighbours(table).toPandas()
    assert recall(found, _exact(rows["vec_id"].to_numpy(), vectors, Search())) >= 0.95
    assert [str(t) for t in found.dtypes] == ["int64", "int32", "int64", "float64"]


def test_copies_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(i, [1.0, 3.0]) for i in range(60, 300)] + [(100, [5.0, 5.0])]
    rows += [(1000, None), (1100, [0.0, 0.0]), (1200, [nan, 1.0]), (1300, [inf, 1.0]), (1400, [None, 1.0]), (1500, []), (None, [1.0, 1.0]), (400, [1.0, 2.0, 3.0]), (200, [1.0, 3.0])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, dim string, cell string")
    found = {}
    for r in nearest_neighbours(table, search=Search(row_block=50)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found[0] == [(i, 0.0) for i in range(1, 11)]
    assert found[200] == [(i, 0.0) for i in range(60, 70)]
    assert set(found) == {0, 100, 200}  # 400 is alone with its length


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [-1e308, 1e308]), (3, [1e-310, 0.0]), (100, [1e-310, 1e-310]), (4, [3.0, 4.0])]
    found = nearest_neighbours(_table(spark, [r[0] for r in rows], [r[1] for r in rows])).collect()
    assert sorted((r.query_id, r.vec_id) for r in found) == sorted((q, i) for q in (0, 100) for i, _ in rows if i != q)


def test_empty_table_and_fewer_than_k(spark):
    assert nearest_neighbours(_table(spark, [], [])).collect() == []
    assert [(r.query_id, r.vec_id) for r in nearest_neighbours(_table(spark, [0, 7], [[1.0], [2.0]])).collect()] == [(0, 7)]


def test_threshold_is_a_binomial_quantile():
    search = Search()
    least, m, p = threshold(search), search.projections, math.erf(1 / math.sqrt(2))
    below = sum(math.comb(m, c) * p**c * (1 - p) ** (m - c) for c in range(least))
    assert below <= search.miss < below + math.comb(m, least) * p**least * (1 - p) ** (m - least)
    hits = (np.abs(np.random.default_rng(0).standard_normal((64, 4000))).T.reshape(-1, 64) <= 1).mean()
    assert abs(hits - p) < 0.01 and collision.directions(5, search).shape == (5, m)
