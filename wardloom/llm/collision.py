"""Approximate nearest neighbours by collision counting.

Every vector is projected on some random directions, one number each. For a pair of vectors at distance ``d`` a projection differs by a normal
variable of deviation ``d``, so two vectors within radius ``R`` collide in a window of half width ``R`` in about two thirds of the projections, and
the number of collisions is binomial. ``threshold`` is the count that a vector within ``R`` misses with probability ``miss`` only; vectors that reach it
are verified by their exact distance.

The index holds blocks of vectors and, for each projection, the order of the block's values. A query lays a window around its own value on each of
these sorted arrays. Virtual rehashing widens all windows together, from radius to larger radius, and counts only what the last step added. The
search of a block ends when the ``k``-th best distance known is not above the radius, as all nearer vectors were counted by then, or when all are
verified.

Blocks are cells around sampled centres, large ones cut by a hash, and every row lies in one. A query first searches one block of its own cell; the
``k``-th distance found there is where it begins, and whether it enters at all, in every other block: a block whose ranges the windows meet in
fewer projections than the threshold holds nothing to count. Equal vectors are one class with its ``k + 1`` smallest ids, which is all that a result can show.
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


@dataclass(frozen=True)
class Search:
    k: int = 10
    every: int = 100
    projections: int = 96
    miss: float = 0.02
    growth: float = 1.15  # of the radius from one rehashing to the next
    cells: int = 256  # centres, a sample of the vectors, and no more of them than blocks
    row_block: int = 8192
    query_block: int = 8192
    seed: int = 20


def directions(dim: int, search: Search) -> np.ndarray:
    return np.random.default_rng([search.seed, dim]).standard_normal((dim, search.projections))


def threshold(search: Search) -> int:
    """The greatest count that a vector within the radius stays below with a probability of at most ``miss``."""
    m, p = search.projections, math.erf(1 / math.sqrt(2))
    below = 0.0
    for count in range(m + 1):
        below += math.comb(m, count) * p**count * (1 - p) ** (m - count)
        if below > search.miss:
            return max(1, count)
    return m


@dataclass
class Block:
    """One block of the index: classes' ids and vectors, and their projections in sorted order."""

    ids: list[np.ndarray]
    vectors: np.ndarray
    order: np.ndarray  # projections x rows
    values: np.ndarray  # sorted, projections x rows


def nearest(query_id: int, query: np.ndarray, own: np.ndarray, bound: float, block: Block, search: Search, least: int) -> list[tuple[float, int]]:
    """(distance, id) of the best ``k`` of a block's verified vectors. ``own``: the query's projections; ``bound``: a distance within which
    ``k`` rows are known to lie, or infinity."""
    n = len(block.ids)
    if math.isfinite(bound):
        if ((block.values[:, 0] <= own + bound) & (block.values[:, -1] >= own - bound)).sum() < least:
            return []
        radius = bound / search.growth**2
    else:  # from where a typical window holds an eighth of the rows
        nth = min(max(search.k, n // 8), n) - 1
        radius = float(np.median(np.partition(np.abs(block.values - own[:, None]), nth, axis=1)[:, nth]))
    at = [int(np.searchsorted(v, x)) for v, x in zip(block.values, own)]
    low, high = list(at), list(at)
    counts, done = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=bool)
    found: list[tuple[float, int]] = []
    while True:
        for j, (values, order, x) in enumerate(zip(block.values, block.order, own)):
            a, b = np.searchsorted(values, (x - radius, np.nextafter(x + radius, math.inf)))
            if a < low[j]:
                counts[order[a : low[j]]] += 1
                low[j] = a
            if b > high[j]:
                counts[order[high[j] : b]] += 1
                high[j] = b
        open_ = math.isfinite(radius) and math.isfinite(float(own.sum()))
        fresh = np.flatnonzero((counts >= least) & ~done) if open_ else np.flatnonzero(~done)  # beyond doubles nothing can be counted: verify all
        done[fresh] = True
        with np.errstate(over="ignore"):
            away = np.sqrt(((block.vectors[fresh] - query) ** 2).sum(axis=1))
        within = np.flatnonzero(away <= bound)
        for i in within[np.argsort(away[within], kind="stable")]:
            if len(found) == search.k and away[i] > found[-1][0]:
                break
            found = sorted(found + [(float(away[i]), int(x)) for x in block.ids[fresh[i]] if x != query_id])[: search.k]
        if len(found) == search.k:
            bound = min(bound, found[-1][0])
        if bound <= radius or done.all():
            return found
        radius = min(radius * search.growth, bound) if radius > 0 else max(np.finfo(float).tiny, float(np.abs(block.values - own[:, None]).max()) / 1024)


def valid_vectors(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, dim, v) of the rows that take part."""
    v, i = F.col(f"`{vector}`"), F.col(f"`{vec_id}`").cast("long")
    fine = v.isNotNull() & i.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return table.where(F.coalesce(fine, F.lit(False))).select(i.alias("vec_id"), F.size(v).alias("dim"), F.transform(v, lambda x: x.cast("double")).alias("v"))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(dim, v, ids): each different vector once, with its ``k + 1`` smallest ids in order. Tasks keep no more than that of a vector before it moves."""
    hashed = rows.withColumn("h", F.xxhash64("v"))
    first = hashed.withColumn("nth", F.row_number().over(Window.partitionBy("h", "dim", "v").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    return first.groupBy("h", "dim", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("dim", "v", "ids")


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(x, dtype=np.float64) for x in column]).reshape(-1, dim)


def _centres(found: DataFrame, search: Search) -> dict[int, np.ndarray]:
    """A bounded sample of the classes, by length of the vectors."""
    count = min(search.cells, math.ceil(found.count() / search.row_block))
    sample = found.select("dim", "v").orderBy(F.xxhash64("v", F.lit(search.seed)), "v").limit(count).collect()
    return {dim: np.array([r["v"] for r in sample if r["dim"] == dim]) for dim in {r["dim"] for r in sample}}


def with_cells(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with ``cell``: the number of the nearest centre."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, v = batch.column("dim").to_numpy(), batch.column("v")
            cells = np.zeros(len(dims), dtype=np.int64)
            for dim in np.unique(dims):
                if dim in centres:
                    at = np.flatnonzero(dims == dim)
                    points, middle = v.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim), centres[dim]
                    with np.errstate(over="ignore", invalid="ignore"):
                        cells[at] = ((middle**2).sum(axis=1) - 2 * points @ middle.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(dealt, f"{fields}, cell long")


def build_index(dealt: DataFrame, search: Search) -> DataFrame:
    """(dim, cell, salt, ids, vectors, orders): one row a block. ``dealt``: (dim, v, ids, cell, salt)."""

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        vectors = _matrix(rows["v"], dim)
        with np.errstate(over="ignore", invalid="ignore"):
            order = np.argsort(vectors @ directions(dim, search), axis=0, kind="stable").T.astype("<u4")
        held = [list(map(int, i)) for i in rows["ids"]]
        return pd.DataFrame({"dim": [dim], "cell": [key[1]], "salt": [key[2]], "ids": [held], "vectors": [vectors.astype("<f8").tobytes()], "orders": [order.tobytes()]})

    return dealt.groupBy("dim", "cell", "salt").applyInPandas(block, "dim int, cell long, salt long, ids array<array<long>>, vectors binary, orders binary")


def search_blocks(questions: DataFrame, index: DataFrame, keys: list[str], search: Search) -> DataFrame:
    """(query_id, vec_id, score): every query in every block of its keys. ``questions``: query_id, dim, v, bound."""
    least = threshold(search)

    def meet(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(rows):
            dim = int(asked["dim"].iloc[0])
            base = directions(dim, search)
            with np.errstate(over="ignore", invalid="ignore"):
                own = _matrix(asked["v"], dim) @ base
            bounds = asked["bound"].fillna(math.inf).to_numpy(dtype=np.float64)
            for ids, vectors, orders in zip(rows["ids"], rows["vectors"], rows["orders"]):
                points = np.frombuffer(vectors, dtype="<f8").reshape(-1, dim)
                order = np.frombuffer(orders, dtype="<u4").reshape(search.projections, -1).astype(np.int64)
                with np.errstate(over="ignore", invalid="ignore"):
                    values = np.take_along_axis((points @ base).T, order, axis=1)
                block = Block([np.asarray(i) for i in ids], points, order, values)
                for query_id, v, projected, bound in zip(asked["query_id"], asked["v"], own, bounds):
                    best = nearest(int(query_id), np.asarray(v, dtype=np.float64), projected, bound, block, search, least)
                    found += [(int(query_id), i, d) for d, i in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return questions.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")


def nearest_neighbours(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", search: Search = Search()) -> DataFrame:
    """``query_id, rank, vec_id, score``: queries are the rows whose id is divisible by ``every``, candidates all rows of other ids.

    ``score`` is the Euclidean distance in doubles; ties go to the smaller id. Null ids and vectors that are null, empty, zero or not wholly finite
    take no part; vectors meet those of their own length only. Repeated rows of an id are one candidate for each different vector, and a query id that has several
    vectors has them all as one query: the nearest to any of them. Other columns are not read. An empty table gives an empty result.
    """
    rows = written(valid_vectors(table, vec_id, vector).dropDuplicates(), "vectors")
    found = written(classes(rows, search.k), "classes")
    centres = _centres(found, search)
    cells = written(with_cells(found, centres), "cells")
    sizes = cells.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / search.row_block).alias("salts"))
    sizes = written(sizes, "sizes")  # at most a row for each centre and length of vectors
    salt = F.pmod(F.xxhash64("v", F.lit(search.seed + 1)), F.col("salts")).alias("salt")
    index = written(build_index(cells.join(sizes, ["dim", "cell"]).select("dim", "cell", "v", "ids", salt), search), "index")
    questions = rows.where(F.col("vec_id") % search.every == 0).withColumnRenamed("vec_id", "query_id")
    asked = with_cells(questions, centres).join(sizes, ["dim", "cell"], "left")
    asked = written(asked.select("query_id", "dim", "v", "cell", F.pmod(F.xxhash64("query_id"), F.coalesce("salts", F.lit(1))).alias("salt")), "queries")

    def best(df: DataFrame) -> DataFrame:
        one = df.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.k)

    home = written(search_blocks(asked.withColumn("bound", F.lit(None).cast("double")), index, ["dim", "cell", "salt"], search), "home")
    bounds = best(home).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == search.k, F.max("score")).alias("bound"))
    # every other block: queries are dealt to blocks of queries, and each of these meets each block of rows by equal keys
    parts = max(1, math.ceil(asked.count() / search.query_block))
    own = F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part")
    blocks = index.groupBy("dim").agg(F.collect_list(F.struct("cell", "salt")).alias("blocks"))
    away = asked.join(bounds, "query_id", "left").join(blocks, "dim").select("query_id", "dim", "v", "bound", own, F.struct("cell", "salt").alias("mine"), F.explode("blocks").alias("there"))
    away = away.where(F.col("there") != F.col("mine")).select("query_id", "dim", "v", "bound", "part", "there.cell", "there.salt")
    dealt = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    rest = search_blocks(away, dealt, ["dim", "cell", "salt", "part"], search)
    return best(home.unionByName(rest)).select("query_id", "rank", "vec_id", "score")


def recall(found: pd.DataFrame, exact: pd.DataFrame) -> float:
    """Share of the exact (query_id, vec_id) that were found."""
    pairs = exact[["query_id", "vec_id"]].merge(found[["query_id", "vec_id"]], on=["query_id", "vec_id"])
    return len(pairs) / max(1, len(exact))


sent_to_tasks(__name__)
