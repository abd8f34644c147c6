"""N-gram Jaccard join, size-aware: subsets for small sets, inverted lists for large ones.

A text is the set of its word shingles. Two sets of n and m shingles whose Jaccard similarity is at least t share at least ``t * max(n, m)``, so a set may
miss at most ``a = n - ceil(t * n)`` of its shingles in a partner. In any fixed order of all shingles two partners then share l of their
first ``a + l`` ones.

1. Equal sets are one class; only one text of each goes on.
2. Of every set the ``a + l`` shingles with the smallest hashes are sent to the bucket of their hash, which finds those that other sets have, too. A set with less than l of
   them has no partner; most sets end here. A shingle is sent once by each task's batch, however many texts have it.
3. For the rest shingles are counted over whole sets. A set with more than ``a`` shingles of its own has no partner; the others are ordered from rare to frequent.
4. Small sets give all pairs of their first ``a + 2`` shingles as keys: partners share a pair. Large sets scan the inverted lists of their first
   ``a + 1`` shingles; small sets stand in those lists if they are large enough to be a partner of a large one, or so small that one common shingle may make a partner. The boundary is where the cost is least: rows
   made of pairs on one side, postings on the other (step 5 spends one row on each), summed over the sets that there are.
5. Sets that share a key are connected by stars, not pairs; what is connected is a block, and no two partners are in different blocks. A
   set is sent to its block once. Inside, sets are compared exactly, but for those that are connected already. A block of too many
   shingles is cut into parts, and every two parts meet in a group of their own.

The result is exact whatever the data: similarities are checked on whole sets, and each step only leaves out what cannot be similar.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import filled, sent_to_tasks, without, written
from wardloom.llm.components import components


@dataclass(frozen=True)
class Join:
    """``percent``: 100 * intersection >= percent * union. ``bucket`` and ``block``: shingles that a task holds at once."""

    words: int = 4
    percent: int = 85
    bucket: int = 250_000
    block: int = 1_000_000
    batch: int = 1_000
    broadcast_rows: int = 2_000_000

    def least(self, n):
        """Shingles that a set of n shares with any partner."""
        return -(-self.percent * n // 100)

    def common(self, n):
        """l of step 2."""
        return np.maximum(1, -(-15 * n // 100))

    def linkable(self, n):
        """Whether a set of n can have a partner that differs."""
        return 100 * n >= self.percent * (n + 1)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Few texts at a time: what a task holds does not depend on the size of Spark's batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Shingler:
    """Shingle hashes of texts; keeps hashes of words between texts, at most ``keep``."""

    keep = 100_000

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted different hashes. A-Z are lower-cased, words end at ASCII white space; too few words are one shingle, none are no shingle."""
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(found) < self.words:
            whole = b"\x00".join([*found, b"%d" % len(found)])
            return np.array([xxhash.xxh3_64_intdigest(whole)] if found else [], dtype=np.uint64)
        if len(self.known) > self.keep:
            self.known.clear()
        known = self.known
        for word in set(found).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        count = len(found) - self.words + 1
        mixed = hashes[:count].copy()
        for i in range(1, self.words):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count]
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9))


def _name(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    digest = xxhash.xxh3_128_digest(hashes.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def shingle_classes(docs: DataFrame, doc_id: str, text: str, join: Join) -> DataFrame:
    """(doc_id, n, c1, c2) of every text: size and name of its set."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(join.words)
        for batch in _slices(batches, join.batch):
            found = [(len(s), *_name(s)) for s in map(shingles, batch.column(1).to_pylist())]
            columns = [pa.array(list(c), pa.int64()) for c in (zip(*found) if found else [[]] * 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "c1", "c2"])

    return rows.mapInArrow(named, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, c1 long, c2 long")


def _sent(texts: list, shingles: Shingler, join: Join, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """A batch's postings by bucket. A shingle of several sets of the batch is sent once, marked; those sets' counts go along."""
    owners, parts = {}, []
    for hashes in map(shingles, texts):
        n = len(hashes)
        if n and join.linkable(n):
            name = _name(hashes)[0]
            if name not in owners:
                owners[name] = len(parts)
                parts.append(hashes[: n - join.least(n) + int(join.common(n))])
    if not parts:
        return
    names = np.array(list(owners), dtype=np.int64)
    flat, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    found, first, times = np.unique(flat, return_index=True, return_counts=True)
    alone = times == 1
    counts = np.bincount(owner[~alone[np.searchsorted(found, flat)]], minlength=len(parts))
    holder = np.where(alone, names[owner[first]], 0)
    place = (found % np.uint64(buckets)).astype(np.int64)
    short = (found // np.uint64(buckets) >> np.uint64(8)).astype(np.uint32)  # may agree by chance: then a set is kept in vain
    order = np.argsort(place, kind="stable")
    home = place[np.searchsorted(found, np.array([p[0] for p in parts], dtype=np.uint64))]  # a set's counts go with its first shingle
    by_home = np.argsort(home, kind="stable")
    occupied, starts = np.unique(place[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    firsts, lasts = (np.searchsorted(home[by_home], occupied, side) for side in ("left", "right"))
    for bucket, start, end, first_, last_ in zip(occupied.tolist(), starts, ends, firsts, lasts):
        own, mine = order[start:end], by_home[first_:last_]
        yield bucket, short[own].tobytes(), holder[own].tobytes(), names[mine].tobytes(), counts[mine].astype(np.int64).tobytes()


def _shared_counts(bucket: pd.DataFrame) -> pd.DataFrame:
    """For each set in the bucket how many of the shingles sent are not its own alone."""
    short = np.concatenate([np.frombuffer(x, np.uint32) for x in bucket["shingles"]])
    holder = np.concatenate([np.frombuffer(x, np.int64) for x in bucket["holders"]])
    found, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(short):
        order = np.lexsort((holder, short))
        short, holder = short[order], holder[order]
        new = np.flatnonzero(np.r_[True, short[1:] != short[:-1]])
        least, most = np.minimum.reduceat(holder, new), np.maximum.reduceat(holder, new)
        marked = np.add.reduceat((holder == 0).astype(np.int64), new) > 0
        shared = np.repeat((least != most) | marked, np.diff(np.r_[new, len(short)]))
        once = np.r_[True, (short[1:] != short[:-1]) | (holder[1:] != holder[:-1])]
        here, n = np.unique(holder[shared & once & (holder != 0)], return_counts=True)
        found.append(here)
        counts.append(n)
    found += [np.frombuffer(x, np.int64) for x in bucket["sets"]]
    counts += [np.frombuffer(x, np.int64) for x in bucket["counts"]]
    return pd.DataFrame({"c1": np.concatenate(found), "shared": np.concatenate(counts)})


def shared_shingles(docs: DataFrame, text: str, join: Join, buckets: int) -> DataFrame:
    """(c1, shared): how many of a set's first shingles other sets may have; never too few."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, names = Shingler(join.words), ["bucket", "shingles", "holders", "sets", "counts"]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for batch in _slices(batches, join.batch):
            rows = list(_sent(batch.column(0).to_pylist(), shingles, join, buckets))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "bucket int, shingles binary, holders binary, sets binary, counts binary"
    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(sent, schema)
    counted = rows.groupBy("bucket").applyInPandas(_shared_counts, "c1 long, shared long")
    return counted.groupBy("c1").agg(F.sum("shared").alias("shared"))


def whole_sets(docs: DataFrame, doc_id: str, text: str, chosen: DataFrame, join: Join) -> DataFrame:
    """(c1, c2, n, shingles) of the texts whose id is in ``chosen`` (doc_id)."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ids = chosen.select(F.col("doc_id").alias("id"))
    ids = F.broadcast(ids) if ids.count() <= join.broadcast_rows else ids
    texts = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, names = Shingler(join.words), ["c1", "c2", "n", "shingles"]
        for batch in _slices(batches, join.batch):
            found = [shingles(t) for t in batch.column(0).to_pylist()]
            named = [_name(s) for s in found]
            flat = pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), flat)
            columns = [pa.array([x[i] for x in named], pa.int64()) for i in (0, 1)] + [pa.array([len(s) for s in found], pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.mapInArrow(sets, "c1 long, c2 long, n long, shingles array<long>")



def ordered_prefixes(sets: DataFrame, join: Join) -> DataFrame:
    """(id, n, room, shared): sets that can have partners, with the shingles that others have, rare ones first; ``room`` is what is left of
    ``a`` after the shingles that no other set has."""
    postings = sets.select("id", F.explode("shingles").alias("s"))
    often = postings.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = postings.join(often, "s").groupBy("id").agg(F.collect_list(F.struct("df", "s")).alias("shared"))
    rows = sets.select("id", "n").join(shared, "id")
    # integer ceiling: no rounding at the boundary
    least = F.expr(f"(n * {join.percent} + 99) div 100")
    room = (F.col("n") - least) - (F.col("n") - F.size("shared"))
    rows = rows.withColumn("room", room.cast("int")).where("room >= 0")
    return rows.select("id", "n", "room", F.slice(F.array_sort("shared"), 1, F.col("room") + 2).alias("shared"))


def boundary(prefixes: DataFrame) -> int:
    """The greatest size of a small set, by least cost over the sets that there are, in steps of an eighth of an octave."""
    step = F.floor(8 * F.log2("n")).cast("int").alias("step")
    pairs = (F.size("shared") * (F.size("shared") - 1) / 2).alias("pairs")
    scans = F.least(F.size("shared"), F.col("room") + 1).alias("scans")
    costs = prefixes.select(step, pairs, scans).groupBy("step").agg(F.sum("pairs").alias("pairs"), F.sum("scans").alias("scans"))
    rows = sorted((r.step, r.pairs, float(r.scans)) for r in costs.collect())  # an entry for each eighth of an octave
    best, cost = 0, sum(r[2] for r in rows)
    now = cost
    for step_, pairs_, scans_ in rows:
        now += pairs_ - scans_
        if now < cost:
            best, cost = math.ceil(2 ** ((step_ + 1) / 8)) - 1, now
    return best


def keys(prefixes: DataFrame, most_small: int, join: Join) -> DataFrame:
    """(key, id): pairs of shingles for small sets, single ones for large sets and for small ones that a large one can match."""
    small = F.col("n") <= most_small
    pairs = F.flatten(
        F.transform(
            "shared",
            lambda x, i: F.transform(F.slice("shared", i + 2, F.size("shared")), lambda y: F.xxhash64(F.lit(2), F.least(x["s"], y["s"]), F.greatest(x["s"], y["s"]))),
        )
    )
    lists = F.transform(F.slice("shared", 1, F.col("room") + 1), lambda x: F.xxhash64(F.lit(1), x["s"]))
    none = F.array().cast("array<long>")
    # partners of fewer than two common shingles have no pair in common
    in_lists = (F.col("n") >= -(-join.percent * (most_small + 1) // 100)) | (F.expr(f"(n * {join.percent} + 99) div 100") < 2)
    every = F.concat(F.when(small, pairs).otherwise(none), F.when(in_lists, lists).otherwise(none))
    return prefixes.select("id", F.explode(F.array_distinct(every)).alias("key"))


def linked(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, join: Join) -> list[tuple[int, int]]:
    """Links that connect whatever is similar among the sets: between one of ``left`` and one of ``right``. Sets that are connected are not
    compared again."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")  # partners of a set that come before it are not larger
    ids, sizes, left, right = ids[order], sizes[order], left[order], right[order]
    found, flat, times = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    rank = np.empty(len(found), dtype=np.int64)
    rank[np.lexsort((found, times))] = np.arange(len(found))  # rare ones first
    edges = np.r_[0, np.cumsum(sizes)]
    ranked = [np.sort(rank[flat[edges[i] : edges[i + 1]]]) for i in range(len(ids))]
    prefixes = [r[: n - join.least(int(n)) + 1] for r, n in zip(ranked, sizes)]
    lengths = np.bincount(np.concatenate(prefixes), minlength=len(found))
    starts = np.r_[0, np.cumsum(lengths)]
    lists, ends = np.empty(starts[-1], dtype=np.int64), starts[:-1].copy()
    root, seen, mark = np.arange(len(ids)), np.zeros(len(ids), dtype=bool), np.zeros(len(found), dtype=bool)
    links, members = [], {i: [i] for i in range(len(ids))}
    for i in range(len(ids)):
        for t in prefixes[i]:
            if ends[t] > starts[t]:
                seen[lists[starts[t] : ends[t]]] = True
            lists[ends[t]] = i
            ends[t] += 1
        others = np.flatnonzero(seen[:i])
        seen[others] = False
        others = others[(root[others] != root[i]) & (100 * sizes[others] >= join.percent * sizes[i])]
        others = others[(left[i] & right[others]) | (right[i] & left[others])]
        if not len(others):
            continue
        mark[ranked[i]] = True
        both = np.add.reduceat(mark[np.concatenate([ranked[j] for j in others])].astype(np.int64), np.r_[0, np.cumsum(sizes[others])[:-1]])
        mark[ranked[i]] = False
        for j in others[100 * both >= join.percent * (sizes[i] + sizes[others] - both)]:
            if root[j] != root[i]:
                links.append((int(ids[i]), int(ids[j])))
                few, many = sorted((int(root[i]), int(root[j])), key=lambda r: len(members[r]))
                root[members[few]] = many  # the smaller side takes the other's name, so a set changes it seldom
                members[many] += members.pop(few)
    return links


def similar_links(sets: DataFrame, closures: DataFrame, join: Join) -> DataFrame:
    """(a, b): links that connect whatever is similar. ``closures`` (id, block): what can be similar is in one block."""
    members = sets.join(closures, "id")
    whole = closures.join(sets.select("id", "n"), "id").groupBy("block").agg(F.ceil(F.sum("n") / join.block).cast("long").alias("parts"))
    members = members.join(written(whole, "blocks"), "block")
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    members = members.select("id", "block", "shingles", part.alias("part"), other.alias("other"))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    members = members.select("id", "block", "shingles", "part", low, high)

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        own = group["part"].to_numpy()
        left, right = own == group["low"].to_numpy(), own == group["high"].to_numpy()
        sets_ = [np.asarray(x, dtype=np.int64) for x in group["shingles"]]
        return pd.DataFrame(linked(group["id"].to_numpy(dtype=np.int64), sets_, left, right, join), columns=["a", "b"]).astype("int64")

    return members.groupBy("block", "low", "high").applyInPandas(compared, "a long, b long")


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every text: the smallest id that links reach, its own if there are none.

    Null and empty texts have no shingle and no link; equal texts are linked; null ids are never the smallest, and rows of one id with
    different texts are texts of their own; an empty table gives an empty result.
    """
    sets = written(shingle_classes(docs, doc_id, text, join), "classes")
    classes = written(sets.where("n > 0").groupBy("c1", "c2", "n").agg(F.min("doc_id").alias("least_id")), "sets")
    total = classes.where(100 * F.col("n") >= join.percent * (F.col("n") + 1)).agg(F.sum("n")).first()[0] or 0
    shared = written(shared_shingles(docs, text, join, max(1, math.ceil(0.3 * total / join.bucket))), "shared")
    least = F.expr(f"(n * {join.percent} + 99) div 100")
    needed = F.greatest(F.lit(1), F.floor((least * 15 + 99) / 100))
    alive = written(classes.join(shared, "c1").where(F.col("shared") >= needed).select("c1", "c2", F.col("least_id").alias("doc_id")), "alive")
    vectors = whole_sets(docs, doc_id, text, written(alive.select("doc_id").distinct(), "chosen"), join)
    vectors = written(vectors.withColumn("id", F.monotonically_increasing_id()), "vectors")
    prefixes = written(ordered_prefixes(vectors, join), "prefixes")
    found = written(keys(prefixes, boundary(prefixes), join), "keys")
    leaders = found.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("held")).where("held > 1").select("key", "a")
    stars = found.join(leaders, "key").select("a", F.col("id").alias("b")).where("a <> b").distinct()
    closures = written(components(stars).select(F.col("node").alias("id"), F.col("root").alias("block")), "closures")
    roots = components(similar_links(vectors, closures, join)).select(F.col("node").alias("id"), "root")
    named = vectors.select("id", "c1", "c2").join(roots, "id").join(classes.select("c1", "c2", "least_id"), ["c1", "c2"])
    named = written(named.select("c1", "c2", "root", "least_id"), "linked")
    smallest = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    reached = named.join(smallest, "root").groupBy("c1", "c2").agg(F.min("component_id").alias("component_id"))
    final = classes.join(reached, ["c1", "c2"], "left").select("c1", "c2", F.coalesce("component_id", "least_id").alias("component_id"))
    joined = sets.join(written(final, "components"), ["c1", "c2"], "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """The rows of ``docs`` but for near copies: of every component the row of the smallest id stays. Texts without shingles have no near
    copies; rows alike in id and text count once."""
    key, place = without(docs.columns, ["key", "place"])
    body, id_ = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    known = F.to_json(F.struct(id_.cast("string").alias("id")))
    digest = F.md5(F.concat(known, F.when(body.isNull(), "-").otherwise("+"), filled(body)).cast("binary"))
    # ordered by id, null ids last; rows of one id with different texts differ by digest, rows alike in both are one until the end
    rows = docs.withColumn(key, F.struct(id_.isNull().alias("none"), id_.alias("id"), digest.alias("digest")))
    found = similar_components(rows, key, text, join)
    stay = found.where(F.col("doc_id.digest") == F.col("component_id.digest")).select(F.col("doc_id.digest").alias(place)).distinct()
    kept = rows.withColumn(place, F.col(f"{key}.digest")).join(written(stay, "stay"), place, "left_semi")
    alike = Window.partitionBy(place).orderBy(F.lit(1))
    return kept.withColumn(key, F.row_number().over(alike)).where(F.col(key) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


sent_to_tasks(__name__)
