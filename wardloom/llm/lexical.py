"""Ranked lexical search by dense blocked multiplication.

Items are the queries, documents are ranked for each. Items are taken in passes of bounded size. A pass has a vocabulary of its items' terms; every
document becomes its length and the frequencies of those terms, once. Items are cut into tiles, and each tile keeps a compact vocabulary of the terms
its items hold. A tile of documents is then a dense matrix of impacts (documents x terms), a tile of items one of weights (terms x items), and
their product all scores of the two tiles at once.

Impacts and weights are whole numbers in float64. An impact is below a million whatever the document, so the sums of weights of a tile's
columns say how large a partial sum can become: terms are dealt to as many slices as keep it below 2^53, where every order of additions
gives the same whole number. Slices are added as 64-bit integers. Each task keeps, for every item, the best ``k`` it has met, equal scores by
smaller id; what tasks found is ranked once more.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import sent_to_tasks, written

EXACT = 1 << 53
MOST_IMPACT = 1_000_000  # (1000000000 * tf) div (1000 * tf + 12 * m) stays below it, as m is at least 75
# a term is a run of ASCII letters, ASCII digits and whatever is not ASCII; all else ends it. In UTF-8 that is decided byte by byte
TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Ranking:
    k: int = 20
    item_tile: int = 64
    term_tile: int = 4096
    doc_tile: int = 1024
    pass_items: int = 4096
    pass_chars: int = 8_000_000  # of the items of one pass, on average


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def slices_of(weights: np.ndarray, term_tile: int, cap: int = (EXACT - 1) // MOST_IMPACT) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, part of the weights): rows of ``weights`` (terms x items, int64) in slices whose columns sum to at most ``cap`` each.
    A weight above ``cap`` is spread over several slices; together the slices are ``weights`` again."""
    found: list[tuple[list[int], list[np.ndarray]]] = []
    used = np.zeros(weights.shape[1], dtype=np.int64)
    for term in range(len(weights)):
        left = weights[term].copy()
        while left.any():
            now = np.minimum(left, cap)
            if not found or len(found[-1][0]) == term_tile or (used + now > cap).any():
                found.append(([], []))
                used = np.zeros_like(used)
            found[-1][0].append(term)
            found[-1][1].append(now)
            used, left = used + now, left - now
    return [(np.array(rows), np.array(part, dtype=np.float64)) for rows, part in found]


def best_of(items: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` of every item, best first, equal scores by smaller id."""
    order = np.lexsort((ids, -scores, items))
    sorted_items = items[order]
    nth = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
    return order[nth < k]


class Tile:
    """A tile of items: its compact vocabulary, its weights in slices, and the best documents met so far."""

    def __init__(self, items: list[tuple[int, dict[int, int]]], weights: np.ndarray, ranking: Ranking):
        self.numbers = np.array([number for number, _ in items], dtype=np.int64)
        self.terms = np.array(sorted({t for _, held in items for t in held}), dtype=np.int64)
        table = np.zeros((len(self.terms), len(items)), dtype=np.int64)
        for column, (_, held) in enumerate(items):
            for term, times in held.items():
                table[np.searchsorted(self.terms, term), column] = weights[term] * times
        self.slices = slices_of(table, ranking.term_tile)
        self.local = np.full(len(weights), -1, dtype=np.int64)
        self.local[self.terms] = np.arange(len(self.terms))
        self.k = ranking.k
        self.items = self.ids = self.scores = np.zeros(0, dtype=np.int64)
        self.least = np.ones(len(items), dtype=np.int64)  # what a document must reach to count

    def add(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """A tile of documents: ``ids`` of its rows, and (row, term, impact) of every term that one holds."""
        column = self.local[term]
        mine = column >= 0
        dense = np.zeros((len(ids), len(self.terms)))
        dense[doc[mine], column[mine]] = impact[mine]
        scores = np.zeros((len(ids), len(self.numbers)), dtype=np.int64)
        for rows, part in self.slices:
            scores += (dense[:, rows] @ part).astype(np.int64)
        row, item = np.nonzero(scores >= self.least)
        items, found = np.concatenate([self.items, item]), np.concatenate([self.scores, scores[row, item]])
        own = np.concatenate([self.ids, ids[row]])
        kept = best_of(items, own, found, self.k)
        self.items, self.ids, self.scores = items[kept], own[kept], found[kept]
        full = np.bincount(self.items, minlength=len(self.numbers)) == self.k
        last = np.searchsorted(self.items, np.arange(len(self.numbers)), "right") - 1
        self.least[full] = self.scores[last[full]]


def _frequencies(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """``doc_id, n, terms, times``: length of every document in terms, and how often it holds which terms of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one pass of items, bounded by its size
    names, kinds = ["doc_id", "n", "terms", "times"], [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            lengths, terms, times = [], [], []
            for given in batch.column(1):
                words = terms_of(given.as_py())
                held = Counter(words)
                mine = sorted((number[w], n) for w, n in held.items() if w in number)
                lengths.append(len(words))
                terms.append([t for t, _ in mine])
                times.append([n for _, n in mine])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, k) for x, k in zip((lengths, terms, times), kinds[1:])]], names=names)

    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")).where("doc_id is not null")
    return given.mapInArrow(counted, "doc_id long, n long, terms array<int>, times array<long>")


def _one_pass(docs: DataFrame, items: list[tuple[object, bytes | None]], kind: str, doc_id: str, text: str, ranking: Ranking) -> DataFrame:
    spark = docs.sparkSession
    held: dict[object, Counter] = {}
    for item, given in items:  # rows of one id are one item
        held.setdefault(item, Counter()).update(terms_of(given))
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in held.values() for t in terms}))}
    counted = written(_frequencies(docs, vocabulary, doc_id, text), "frequencies")
    n, length = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():  # at most the pass's vocabulary
        df[r["term"]] = r["df"]
    weights = np.array([weight(n, int(d)) for d in df], dtype=np.int64)
    queries = [(number, {vocabulary[t]: c for t, c in terms.items()}) for number, terms in enumerate(held.values())]
    sent = spark.sparkContext.broadcast((queries, weights, n, length))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, n, length = sent.value
        tiles = [Tile(queries[i : i + ranking.item_tile], weights, ranking) for i in range(0, len(queries), ranking.item_tile)]
        for batch in batches:
            for at in range(0, batch.num_rows, ranking.doc_tile):
                part = batch.slice(at, ranking.doc_tile)
                ids, own, terms, times = (part.column(i) for i in range(4))
                counts = np.diff(terms.offsets.to_numpy())
                doc = np.repeat(np.arange(len(counts)), counts)
                term, tf = terms.flatten().to_numpy(), times.flatten().to_numpy()
                m = np.array([75 + 25 * int(x) * n // max(length, 1) for x in own.to_pylist()], dtype=np.int64)  # in Python's integers, which cannot overflow
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
                for tile in tiles:
                    tile.add(ids.to_numpy(), doc, term, impact)
        for tile in tiles:
            columns = [tile.numbers[tile.items], tile.ids, tile.scores]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["number", "doc_id", "score"])

    found = counted.where("n > 0").mapInArrow(ranked, "number long, doc_id long, score long")
    named = spark.createDataFrame(list(enumerate(held)), f"number long, item_id {kind}")
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), "doc_id")
    last = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.k)
    return last.join(F.broadcast(named), "number").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", ranking: Ranking = Ranking()) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for each item, equal scores by smaller id.

    Rows without id take no part. Rows of the same item id are one item; every row of documents is a document of its own, with equal ids too. Null and
    empty texts have no terms: such a document counts for nothing, such an item has no result. Texts are taken whole, however long. Other columns are not
    read. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    given = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").cast("binary").alias("text")).where("item_id is not null")
    kind = given.schema["item_id"].dataType.simpleString()
    n, chars = given.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    passes = max(math.ceil(n / ranking.pass_items), math.ceil(chars / ranking.pass_chars))
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for i in range(passes):
        mine = given.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).collect()  # one pass of the items, of bounded size
        if mine:
            result = result.unionByName(_one_pass(docs, [(r["item_id"], None if r["text"] is None else bytes(r["text"])) for r in mine], kind, doc_id, text, ranking))
    return result


sent_to_tasks(__name__)
