"""Exact top-k search by inner product with a pivot table.

Of every vector the distances to some pivots are computed once. For a query q and a vector x the triangle inequality gives
``|q - x| >= max over pivots of |d(q, pivot) - d(x, pivot)|``, and as ``2 q.x = |q|^2 + |x|^2 - |q - x|^2``, the greatest of these
lower bounds bounds the score from above. Candidates are scored in the order of their bounds, in growing steps, until the next bound is below the
k-th best score: everything after it is out, too, so the result is exact.

Rows are vectors of integers packed in blocks. Queries are cut into blocks and so are the rows; each pair of blocks is a group of its own, whose
size does not grow with the table. A bounded sample of rows gives pivots and a first threshold for each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import sent_to_tasks, written

EXACT = float(1 << 53)  # integers below it are exact as doubles


@dataclass(frozen=True)
class Search:
    k: int = 5
    scale: int = 256
    every: int = 50
    pivots: int = 32
    sample: int = 2048  # rows from which pivots and first thresholds come
    query_block: int = 1024
    row_block: int = 8192
    first_step: int = 512


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the sampled vector farthest from those before it."""
    chosen = [0]
    away = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(rows), 0))


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as exact integers; in Python's integers where doubles could round, held to the range of a long."""
    if len(rows) and len(query) * float(np.abs(rows).max()) * float(np.abs(query).max()) >= EXACT:
        exact = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in rows]
        return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in exact], dtype=np.int64)
    return (rows @ query).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, ~scores))[:k]  # ~s is -s - 1, which cannot overflow
    return ids[order], scores[order]


def _below(score: np.int64) -> float:
    """The score as a double, not rounded up."""
    return float(np.nextafter(float(score), -math.inf)) if abs(int(score)) >= EXACT else float(score)


def search_block(query_id: int, query: np.ndarray, near: np.ndarray, ids: np.ndarray, rows: np.ndarray, start: np.ndarray, k: int,
                 step: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of the rows that can still be among the best. ``near``: upper bounds; ``start``: scores that others reach already."""
    best_ids, best = ids[:0], np.zeros(0, dtype=np.int64)
    threshold = _below(np.sort(start)[-k]) if len(start) >= k else -math.inf
    open_ = np.flatnonzero((near >= threshold) & (ids != query_id))
    order = open_[np.argsort(-near[open_], kind="stable")]
    at = 0
    while at < len(order) and near[order[at]] >= threshold:
        now = order[at : at + step]
        best_ids, best = _best(np.concatenate([best_ids, ids[now]]), np.concatenate([best, _scores(rows[now], query)]), k)
        if len(best) == k:
            threshold = max(threshold, _below(best[-1]))
        at, step = at + step, step * 2
    return best_ids, best


def valid_vectors(table: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, dim, v): integers of the rows that take part, each (id, vector) once."""
    v, i = F.col(f"`{vector}`"), F.col(f"`{vec_id}`").cast("long")
    fine = v.isNotNull() & i.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    # floor() of a double is a long, which holds up to 2^63: larger components stay doubles, they have no fraction anyway
    wide = lambda x: F.lit(float(scale)) * x.cast("double")
    ints = F.transform(v, lambda x: F.when(F.abs(x.cast("double")) < float(1 << 53) / scale, F.floor(wide(x)).cast("double")).otherwise(wide(x)))
    return table.where(fine).select(i.alias("vec_id"), F.size(v).alias("dim"), ints.alias("v")).where("dim > 0").dropDuplicates()


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(x, dtype=np.float64) for x in column]).reshape(-1, dim)


def top_k(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", search: Search = Search()) -> DataFrame:
    """``query_id, rank, vec_id, score``: queries are the rows whose id is divisible by ``every``, candidates all rows of other ids.

    Null ids and null, empty or not wholly finite vectors take no part; equal rows count once; vectors meet those of their own length only;
    ties go to the smaller id; scores beyond 64 bits are held at the bound; an empty table gives an empty result.
    """
    rows = written(valid_vectors(table, vec_id, vector, search.scale), "vectors")
    sampled: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim, group in pd.DataFrame(
        [(r.dim, r.vec_id, r.v) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(search.sample).collect()], columns=["dim", "id", "v"]
    ).groupby("dim"):
        vectors = _matrix(group["v"], int(dim))
        sampled[int(dim)] = group["id"].to_numpy(dtype=np.int64), vectors, _pivots(vectors, search.pivots)

    def with_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            near = np.empty(len(frame), dtype=object)
            for dim, group in frame.groupby("dim"):
                pivots = sampled[dim][2] if dim in sampled else np.zeros((0, dim))
                for at, d in zip(group.index, _distances(_matrix(group["v"], dim), pivots)):
                    near[at] = d
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(near), pa.list_(pa.float64()))], names=[*batch.schema.names, "near"])

    pivoted = written(rows.mapInArrow(with_distances, "vec_id long, dim int, v array<double>, near array<double>"), "pivots")
    asked = pivoted.where(F.col("vec_id") % search.every == 0)
    sizes = pivoted.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % search.every == 0, 1))).first()
    parts, blocks = max(1, math.ceil(sizes[0] / search.row_block)), max(1, math.ceil(sizes[1] / search.query_block))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    questions = asked.select("*", own, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part")
    candidates = pivoted.select("*", own, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def meet(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            dim = int(queries["dim"].iloc[0])
            ids, matrix = block["vec_id"].to_numpy(dtype=np.int64), _matrix(block["v"], dim)
            known_ids, known, _ = sampled.get(dim, (np.zeros(0, dtype=np.int64), np.zeros((0, dim)), None))
            squares = (matrix**2).sum(axis=1)
            pivots = len(block["near"].iloc[0])
            from_pivots = np.ascontiguousarray(_matrix(block["near"], pivots).T) if pivots else np.zeros((0, len(ids)))
            for query_id, v, near in zip(queries["vec_id"], queries["v"], queries["near"]):
                query = np.asarray(v, dtype=np.float64)
                bound = np.zeros(len(ids))
                with np.errstate(over="ignore", invalid="ignore"):
                    for a, b in zip(near, from_pivots):
                        np.maximum(bound, np.abs(b - a), out=bound)
                    bound *= 1 - 1e-9  # what rounding may have added
                    square = float(query @ query)
                    upper = (square + squares - bound**2) / 2
                    upper += 1 + 1e-9 * (square + squares)
                upper[~np.isfinite(upper)] = math.inf  # squares beyond doubles bound nothing
                start = _scores(known[known_ids != query_id], query)
                best_ids, best = search_block(query_id, query, upper, ids, matrix, start, search.k, search.first_step)
                found += [(query_id, int(i), int(s)) for i, s in zip(best_ids, best)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["dim", "block", "part"]
    met = questions.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.dropDuplicates().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


sent_to_tasks(__name__)
