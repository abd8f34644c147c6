"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Texts become token ids and an end mark; what is longer than a sequence is cut, the first piece being the shorter one. Documents and gaps
(sequences with room left) lie in order of size, and the order is kept as runs: equally long documents are one run of ranks, equally
wide gaps are runs of sequence numbers. A round is

1. a range-sort of documents and gaps by size;
2. in every range a sweep from narrow to wide: each gap is the successor of the documents met before it, and takes the longest one that
   no narrower gap has taken;
3. conflicts are resolved by rank: a run of gaps takes documents of a run in the order of their ranks, the longer run first. A gap that
   holds a length several times takes as many, as best fit would do one after another;
4. gaps are updated: filled ones go, the rest become runs of their new width.

What found no gap in its range meets wider ones in the next round, whose ranges are twice as wide. Lengths that no gap holds at all are given
new sequences: all longer than half a sequence at once, as no two share one, and for the rest as many as their tokens fill, which no
packing could do without. The number of rounds (10 to 25 were seen) does not depend on the number of documents. There are at most as many
lengths as tokens in a sequence, so a round works on a few thousand runs whatever the corpus; the documents themselves are ranked
once, by counts for each task, and find their run's place by one join on the length at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.bytebpe import encoder
from wardloom.llm.common import sent_to_tasks, written


@dataclass(frozen=True)
class Packed:
    """``pieces``: row, piece, start, length, ids (little-endian unsigned 32-bit), and the rank of the piece as (task, place) in its
    length. ``placed``: task, length, place, sequence_id, offset."""

    pieces: DataFrame
    placements: DataFrame
    offsets: DataFrame

    def place(self, pieces: DataFrame) -> DataFrame:
        """Any choice of columns of ``pieces`` that keeps task, length and place, with sequence_id and offset in their stead."""
        ranked = pieces.join(self.offsets, ["task", "length"]).withColumn("rank", F.col("before") + F.col("place")).drop("task", "place", "before")
        runs = self.placements.withColumnRenamed("length", "of")
        here = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("doc")) & (F.col("rank") < F.col("doc") + F.col("n"))
        found = ranked.join(runs, here)
        nth = F.col("rank") - F.col("doc")
        sequence, offset = F.col("sequence") + F.floor(nth / F.col("per")), F.col("at") + (nth % F.col("per")) * F.col("length")
        kept = [c for c in ranked.columns if c != "rank"]
        return found.select(*kept, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def token_pieces(docs: DataFrame, path: str, most: int = 2048, end: int = 0, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Pieces of every text, with their place among the equally long ones of the same task. A null text is empty: its one token is the end mark."""
    with open(path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, not data
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text"))
    names = ["piece", "start", "length", "task", "place", "ids"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(sent.value), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            texts = batch.column(1)
            at = 0
            while at < len(texts):
                rows, found, size = [], [], 0
                while at < len(texts) and size < 4_000_000:  # bounded output batches, however long a text is
                    ids = np.append(encode(texts[at].as_py() or ""), np.uint32(end)).astype("<u4")
                    first = (len(ids) - 1) % most + 1
                    for piece, stop in enumerate(range(first, len(ids) + 1, most)):
                        start = max(0, stop - most) if piece else 0
                        place = seen.get(stop - start, 0)
                        seen[stop - start] = place + 1
                        rows.append(at)
                        found.append((piece, start, stop - start, task, place, ids[start:stop].tobytes()))
                    at, size = at + 1, size + 4 * len(ids)
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=["row", *names])

    schema = f"row {named.schema['row'].dataType.simpleString()}, piece int, start long, length long, task long, place long, ids binary"
    return named.mapInArrow(cut, schema)


RUNS = "kind string, size long, first long, n long, per long, sequence long, at long"


def sweep(runs: list[tuple[str, int, int, int]], most: int) -> list[tuple]:
    """One range: (kind, size, first, n) of documents and gaps gives what is left of them, and ``placed`` runs: n documents of a size from
    rank ``first`` on go to the sequences from ``sequence`` on, ``per`` in each, the first of them at ``at``."""
    out, waiting = [], []
    for kind, size, first, n in sorted(runs, key=lambda r: (r[1], r[0])):  # documents before gaps of their size
        if kind == "doc":
            waiting.append((size, first, n))
            continue
        while n and waiting:
            length, rank, count = waiting.pop()
            per = size // length
            slots = min(-(-count // per), n)
            docs = min(count, slots * per)
            out.append(("placed", length, rank, docs, per, first, most - size))
            full, rest = divmod(docs, per)
            out += [("gap", size - per * length, first, full)] * (full > 0 and size > per * length)
            out += [("gap", size - rest * length, first + full, 1)] * (rest > 0)
            if docs < count:
                waiting.append((length, rank + docs, count - docs))
            first, n = first + slots, n - slots
        out += [("gap", size, first, n)] * (n > 0)
    out += [("doc", *run) for run in waiting]
    return [r if len(r) == 7 else (*r, None, None, None) for r in out]


def new_sequences(lengths: list[tuple[int, int]], widest: int, most: int) -> int:
    """How many sequences to begin for the (length, n) that no gap holds."""
    homeless = [(length, n) for length, n in lengths if length > widest]
    alone = sum(n for length, n in homeless if 2 * length > most)
    return alone or (max(1, sum(length * n for length, n in homeless) // most) if homeless else 0)


def best_fit(lengths: DataFrame, most: int, ranges: int = 8) -> DataFrame:
    """``length, doc, n, per, sequence, at`` from (length, n): documents ``doc`` to ``doc + n - 1`` of a length go to the sequences from
    ``sequence`` on, ``per`` in each, the first of them at ``at``."""
    spark = lengths.sparkSession

    def swept(runs: pd.DataFrame) -> pd.DataFrame:
        found = sweep(list(runs[["kind", "size", "first", "n"]].itertuples(index=False, name=None)), most)
        columns = ["kind", "size", "first", "n", "per", "sequence", "at"]
        return pd.DataFrame(found, columns=columns).astype({c: "Int64" for c in columns[1:]})

    zero = F.lit(0).cast("long").alias("first")
    state = written(lengths.select(F.lit("doc").alias("kind"), F.col("length").alias("size"), zero, "n"), "runs")
    steps: list[DataFrame] = []
    sequences = 0
    while True:
        doc = F.when(F.col("kind") == "doc", F.struct("size", "n"))
        docs, widest = state.agg(F.collect_list(doc), F.max(F.when(F.col("kind") == "gap", F.col("size")))).first()
        if not docs:
            break
        begun = new_sequences([(r["size"], r["n"]) for r in docs], widest or 0, most)
        if begun:
            row = [F.lit(x).cast("long").alias(c) for c, x in (("size", most), ("first", sequences), ("n", begun))]
            state = state.unionByName(spark.range(1).select(F.lit("gap").alias("kind"), *row))
            sequences += begun
        ranged = state.withColumn("range", F.floor((F.col("size") - 1) * max(1, ranges >> len(steps)) / most))
        result = written(ranged.groupBy("range").applyInPandas(swept, RUNS), "round")
        placed = result.where("kind = 'placed'")
        steps.append(placed.select(F.col("size").alias("length"), F.col("first").alias("doc"), "n", "per", "sequence", "at"))
        state = result.where("kind <> 'placed'").select("kind", "size", "first", "n")
    if not steps:
        return spark.createDataFrame([], "length long, doc long, n long, per long, sequence long, at long")
    all_steps = steps[0]
    for step in steps[1:]:
        all_steps = all_steps.unionByName(step)
    return written(all_steps.coalesce(1), "placements")


def pack(docs: DataFrame, path: str, most: int = 2048, end: int = 0, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> Packed:
    """Pieces of all documents and where they go. Equal rows and equal ids are documents of their own; an empty table has no pieces."""
    pieces = written(token_pieces(docs, path, most, end, text, carry), "pieces", compression="zstd")
    counts = written(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placements = best_fit(counts.groupBy("length").agg(F.sum("n").alias("n")), most)
    return Packed(pieces, placements, written(offsets, "offsets"))


def packed_pieces(packed: Packed) -> DataFrame:
    """row, piece, start, length, ids, sequence_id, offset."""
    return packed.place(packed.pieces)


def sequences(packed: Packed) -> DataFrame:
    """``sequence_id, ids``: each sequence's ids, its pieces in order. The one step that moves the tokens."""
    part = F.struct("offset", "ids")
    whole = packed.place(packed.pieces.select("task", "length", "place", "ids")).groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return whole.select("sequence_id", ids.alias("ids"))


sent_to_tasks(__name__)
