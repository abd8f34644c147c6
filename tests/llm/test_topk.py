import numpy as np
import pytest

from wardloom.llm import topk


def best(rows, every, k=5):
    """rows: (id, integers), each once."""
    found = set()
    for q, v in rows:
        if q % every == 0:
            scored = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return found


@pytest.mark.parametrize("kind", ["cloud", "clusters", "ties"])
def test_matches_all_scores(spark, kind):
    rng = np.random.default_rng(11)
    if kind == "cloud":
        vectors = rng.normal(size=(400, 8))
    elif kind == "clusters":
        vectors = rng.normal(size=(5, 8))[rng.integers(5, size=400)] + 0.01 * rng.normal(size=(400, 8))
    else:
        vectors = np.repeat(rng.integers(-1, 2, size=(8, 4)), 50, axis=0).astype(float)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    search = topk.Search(every=7, pivots=6, sample=50, query_block=16, row_block=64, first_step=3)
    found = {tuple(r) for r in topk.top_k(table, search=search).collect()}
    assert found == best([(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows], 7)


def test_candidates_are_scored_in_bound_order_until_none_can_win():
    rng = np.random.default_rng(12)
    rows = rng.normal(size=(500, 3)).round(2) * 100
    query = rows[0]
    scored = []
    kept = topk._scores
    try:
        topk._scores = lambda r, q: scored.append(len(r)) or kept(r, q)
        near = rows @ query + rng.uniform(0, 50, 500)  # valid upper bounds
        ids, scores = topk.search_block(0, query, near, np.arange(500), rows, np.zeros(0, dtype=np.int64), 5, 4)
    finally:
        topk._scores = kept
    order = sorted((-int(s), i) for i, s in enumerate(kept(rows, query)) if i)[:5]
    assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == order and sum(scored) < 100


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 0.0], 1), (5, [], 1),
        (None, [9.0, 9.0], 1), (6, [0.5, 0.5], 1), (7, [0.5, 0.5], 1), (8, [1.0, 2.0, 3.0], 1), (50, [1.0, 1.0, 1.0], 1), (9, [-0.001, 0.0], 1),
    ]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 6, 32768), (0, 2, 7, 32768), (0, 3, 9, -256), (50, 1, 8, 256 * 256 * 6)]


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 1 / 256]), (2, [2.0**20, 0.0]), (3, [1e300, 0.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(3, 2**63 - 1), (1, 2**56 + 256), (2, 2**56)]


def test_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_each_component_is_floored_for_itself(spark):
    rows = spark.createDataFrame([(0, [1e20, -0.3]), (1, [0.1, -0.3])], "vec_id long, embedding array<double>")
    assert {r.vec_id: tuple(r.v) for r in topk.valid_vectors(rows, "vec_id", "embedding", 256).collect()} == {0: (256e20, -77.0), 1: (25.0, -77.0)}
