"""Alignment of two tokenizers over the same texts.

Both tokenizers cut the bytes of a text, so every token is a range of bytes. For a batch of documents the tokens of either side are a sorted table
(document, start); one ``merge_asof`` keyed by document finds for each token the other side's token that covers its start. Two tokens overlap
exactly if one of them covers the other's start, so the union of both directions gives all links, each once: a link whose tokens start at the same
byte is found from both sides and counted from one. An end of a token is the start of the next, so where both sides start together a group begins.

Links are counted over the corpus by id pair, each document once. The counts go back to the documents in two ways that together are whole:
pairs that many documents hold are at most ``most_pairs`` by the choice of the least count, and are sent to every task; all other pairs
meet their rows by a shuffle, in which no key can be hot, as few documents hold it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm import bytebpe
from wardloom.llm.common import sent_to_tasks, without, written

SPACE_MARK = "▁"  # fixed value: how pieces spell a space
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Aligned(NamedTuple):
    """Tokens of a batch, in document order. ``doc``: a token's document; ``group``: its group, numbered through the batch."""

    doc_a: np.ndarray
    doc_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray  # token numbers of each link
    link_b: np.ndarray


def piece_bytes(model: bytes) -> list[bytes]:
    """The bytes of every id of a piece model."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    found = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
    return found


def align_batch(sizes_a: list[np.ndarray], sizes_b: list[np.ndarray]) -> Aligned:
    """From the byte lengths of every document's tokens; both sides of a document have the same bytes in all."""
    doc_a = np.repeat(np.arange(len(sizes_a)), [len(s) for s in sizes_a])
    doc_b = np.repeat(np.arange(len(sizes_b)), [len(s) for s in sizes_b])
    ends_a, ends_b = np.cumsum(np.concatenate([[0], *sizes_a])).astype(np.int64), np.cumsum(np.concatenate([[0], *sizes_b])).astype(np.int64)
    left = pd.DataFrame({"doc": doc_a, "start": ends_a[:-1], "a": np.arange(len(doc_a))})
    right = pd.DataFrame({"doc": doc_b, "start": ends_b[:-1], "b": np.arange(len(doc_b))})
    over_a = pd.merge_asof(left, right, on="start", by="doc")["b"].to_numpy(dtype=np.int64)
    over_b = pd.merge_asof(right, left, on="start", by="doc")["a"].to_numpy(dtype=np.int64)
    begins_a, begins_b = ends_b[over_a] == ends_a[:-1], ends_a[over_b] == ends_b[:-1]
    later = ~begins_b  # links between tokens that start together came from the first direction
    return Aligned(
        doc_a, doc_b, np.cumsum(begins_a), np.cumsum(begins_b),
        np.concatenate([left["a"].to_numpy(), over_b[later]]), np.concatenate([over_a, right["b"].to_numpy()[later]]),
    )


def group_texts(found: Aligned, ids_a: np.ndarray, ids_b: np.ndarray, names_a: tuple, names_b: tuple, docs: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document. ``names``: every id with a comma behind it, and with the side's closing mark."""
    parts = np.empty(len(ids_a) + len(ids_b), dtype=object)
    owner = np.empty(len(parts), dtype=np.int64)
    for ids, group, other, side, doc, (inner, last) in (
        (ids_a, found.group_a, found.group_b, "left", found.doc_a, names_a),
        (ids_b, found.group_b, found.group_a, "right", found.doc_b, names_b),
    ):
        at = np.arange(len(ids)) + np.searchsorted(other, group, side)
        closes = np.append(group[1:] != group[:-1], True)[: len(ids)]
        parts[at] = np.where(closes, last[ids], inner[ids])
        owner[at] = doc
    cuts = np.searchsorted(owner, np.arange(docs + 1))
    whole = parts.tolist()
    return ["".join(whole[a:b])[:-1] for a, b in zip(cuts[:-1], cuts[1:])]


def _names(count: int, close: str) -> tuple[np.ndarray, np.ndarray]:
    return np.array([f"{i}," for i in range(count)], dtype=object), np.array([f"{i}{close}" for i in range(count)], dtype=object)


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", carry: Sequence[str] = ("doc_id",), batch_chars: int = 1_000_000) -> DataFrame:
    """``row, key, n_a, n_b, n_groups, n_links, groups, pairs, times``: how the tokens of ``path_a`` (a byte-level ``tokenizer.json``, given the
    text behind a space) and of ``path_b`` (a piece model, which adds the space) lie over each other.

    ``groups`` spells the groups, ``pairs`` are the different linked id pairs (a * size of b + b) and ``times`` how often each is linked. ``key``
    tells rows apart, equal ones too; it is fixed once the result is written. Texts that are null, empty or that either side does not give back byte for
    byte have no tokens. Long texts are taken whole, a batch being closed after ``batch_chars`` characters; an empty table has no rows.
    """
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        sent = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # vocabulary files, not data
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text"))
    columns = ["key", *COUNTS, "groups", "pairs", "times"]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        file_a, model = sent.value
        encode, pieces = bytebpe.encoder(file_a, plain=True), sentencepiece.SentencePieceProcessor(model_proto=model)
        bytes_a, bytes_b = bytebpe.token_bytes(file_a), piece_bytes(model)
        size_a, size_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (bytes_a, bytes_b))
        names_a, names_b = _names(len(bytes_a), "|"), _names(len(bytes_b), ";")
        none = np.zeros(0, dtype=np.int64)
        key = TaskContext.get().partitionId() << 40

        def tokens(given: str | None) -> tuple[np.ndarray, np.ndarray]:
            if not given:
                return none, none
            whole = f" {given}".encode()
            a, b = encode(f" {given}").astype(np.int64), np.array(pieces.encode(given), dtype=np.int64)
            same = all(b"".join([table[i] for i in ids.tolist()]) == whole for table, ids in ((bytes_a, a), (bytes_b, b)))
            return (a, b) if same else (none, none)

        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):
                first, chars, sides = at, 0, []
                while at < len(texts) and chars < batch_chars:
                    given = texts[at].as_py()
                    sides.append(tokens(given))
                    at, chars = at + 1, chars + len(given or "")
                n = len(sides)
                ids_a, ids_b = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
                found = align_batch([size_a[s[0]] for s in sides], [size_b[s[1]] for s in sides])
                groups = group_texts(found, ids_a, ids_b, names_a, names_b, n)
                own = found.doc_a[found.link_a]
                begins = np.append(True, found.group_a[1:] != found.group_a[:-1])[: len(ids_a)]
                space = len(bytes_a) * len(bytes_b)
                codes, times = np.unique(own * space + ids_a[found.link_a] * len(bytes_b) + ids_b[found.link_b], return_counts=True)
                cuts = pa.array(np.searchsorted(codes, np.arange(n + 1) * space), pa.int32())
                numbers = [key + np.arange(n), *(np.bincount(x, minlength=n) for x in (found.doc_a, found.doc_b, found.doc_a[begins], own))]
                key += n
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x, kind)) for x, kind in ((codes % space, pa.int64()), (times, pa.int32()))]
                made = [*[pa.array(x, pa.int64()) for x in numbers], pa.array(groups, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *[x.cast(k) for x, k in zip(made, kinds)]], names=["row", *columns])

    schema = f"row {named.schema['row'].dataType.simpleString()}, key long, {', '.join(f'{c} long' for c in COUNTS)}, groups string, pairs array<long>, times array<int>"
    return named.mapInArrow(aligned, schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, docs, best``: in how many documents an id pair is linked, and whether no pair of its A id has more. ``aligned`` is a written table."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    a = F.floor(F.col("pair") / F.lit(size_b)).alias("a")  # exact: pairs lie far below 2^53
    highest = counts.groupBy(a).agg(F.max("docs").alias("highest"))
    return written(counts.withColumn("a", a).join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best")), "pair-ranks")


def _least_count(counts: DataFrame, most_pairs: int) -> int:
    """A power of two that at most ``most_pairs`` pairs reach."""
    by_power = {r["p"]: r["n"] for r in counts.groupBy(F.floor(F.log2("docs")).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    power, held = max(by_power, default=0) + 1, 0
    while power > 0 and held + by_power.get(power - 1, 0) <= most_pairs:
        power -= 1
        held += by_power.get(power, 0)
    return 1 << power


def with_link_counts(aligned: DataFrame, counts: DataFrame, most_pairs: int = 500_000) -> DataFrame:
    """``aligned`` with ``n_best`` (links whose pair no other of the same A id outnumbers) and ``count_sum`` (documents, summed over links).
    Both are written tables."""
    taken = without(aligned.columns, ["one"])[0]
    least = _least_count(counts, most_pairs)
    links = aligned.select("key", F.explode(F.arrays_zip("pairs", "times")).alias(taken)).select("key", f"{taken}.pairs", f"{taken}.times").withColumnRenamed("pairs", "pair")
    n_best, count_sum = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("docs") * F.col("times")).alias("count_sum")
    marked = links.join(F.broadcast(counts.where(F.col("docs") >= least)), "pair", "left")
    sums = marked.where(F.col("docs").isNotNull()).groupBy("key").agg(n_best, count_sum)
    if least > 1:
        rest = marked.where(F.col("docs").isNull()).select("key", "pair", "times").join(counts.where(F.col("docs") < least), "pair")
        sums = sums.unionByName(rest.groupBy("key").agg(n_best, count_sum)).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return aligned.join(sums, "key", "left").select(*aligned.columns, *zero)


sent_to_tasks(__name__)
