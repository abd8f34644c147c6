"""Mixing sources to target weights by pivotal dependent rounding.

A document is wanted ``rate`` times, the rate of its source: its whole part is copied for certain, the rest is a probability.
Rounding each alone would miss the target by the square root of the number of documents. Here two fractional documents meet, and
words are moved at random from one's expectation to the other's until one of the two is a whole number; expectations stay what
they were and the sum of expected words does not change at all. What is left fractional goes on to the next meeting.

Meetings form a reduction tree: every source's documents are dealt into leaves of about ``fan`` by a hash; a leaf is folded inside
one row and leaves a single fractional document; ``fan`` leaves form a node of the next level, and so on to one residual for each
source, which is drawn last. So a source misses its target by less than one document, no task ever holds more than a few hundred
narrow rows of a node, and a source with a third of all rows only has more leaves. All chance comes from hashes of the rows'
contents, so that reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import filled, without, words_of, written

WEIGHTS = (3, 1, 2)


def n_words(text: str) -> Column:
    return F.size(words_of(filled(F.col(f"`{text}`")))).cast("long")


def unit(doc_id: str, source: str, text: str) -> Column:
    """A digest of the row: rows that agree in id, source and text are one unit."""
    head = F.to_json(F.struct(F.col(f"`{doc_id}`").cast("string").alias("i"), F.col(f"`{source}`").cast("string").alias("s")))
    return F.md5(F.concat(head, F.when(F.col(f"`{text}`").isNull(), "-").otherwise("+"), filled(F.col(f"`{text}`"))).cast("binary"))


def source_targets(units: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, units, target) from (source, size, n).

    Sources in code point order, null last, have ``weights`` in turn and share ``share`` times all words; none gets more than
    ``most`` times its own, and the excess is shared anew. The common level ``v`` solves ``sum(min(most * size, v * weight))
    = share * total``: as that sum is concave, ``v`` is the greatest solution over all prefixes of the sources by ``size / weight``.
    One row for each source takes part.
    """
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    levels = sizes.withColumn("level", (share * total - full) / open_weight)
    level = F.max("level").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), level * F.col("weight")).cast("double")
    return levels.select("source", "source_size", "units", target.alias("target"))


def _chance(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _meet(state: Column, other: Column, seed: int) -> Column:
    """Two documents meet: one is decided, the other is held on with what fraction it has then."""
    held = state["held"]
    a, p, b, q = held["words"], held["p"], other["words"], other["p"]
    up = F.least(a * (1 - p), b * q)  # words that can move to the held document
    down = F.least(a * p, b * (1 - q))  # and from it
    to_held = _chance(held["h"], other["h"], F.lit(seed)) * (up + down) < down
    held_ends = F.when(to_held, a * (1 - p) <= b * q).otherwise(a * p <= b * (1 - q))
    end = F.when(held_ends == to_held, F.lit(1)).otherwise(F.lit(0))
    left = F.when(
        held_ends, F.struct(other["h"].alias("h"), other["unit"].alias("unit"), b.alias("words"), F.when(to_held, q - up / b).otherwise(q + down / b).alias("p"))
    ).otherwise(F.struct(held["h"].alias("h"), held["unit"].alias("unit"), a.alias("words"), F.when(to_held, p + up / a).otherwise(p - down / a).alias("p")))
    ended = F.struct(F.when(held_ends, held["unit"]).otherwise(other["unit"]).alias("unit"), end.alias("up"))
    return F.struct(left.alias("held"), F.concat(state["done"], F.array(ended)).alias("done"))


def _folded(items: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Each node's documents, in hash order, meet one after another."""
    nodes = items.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("h", "unit", "words", "p"))).alias("all"))
    none = F.array().cast("array<struct<unit:string,up:int>>")
    start = F.struct(F.get("all", F.lit(0)).alias("held"), none.alias("done"))
    end = F.aggregate(F.slice("all", 2, F.size("all")), start, lambda s, x: _meet(s, x, seed))
    return nodes.select(*keys, end.alias("end")).select(*keys, "end.held", "end.done")


def copies(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS,
           share: float = 1.5, most: float = 2.0, fan: int = 64, seed: int = 0) -> DataFrame:
    """Per unit of equal rows: ``unit, doc_id, source, size, n, source_size, target, copies`` (copies of all its ``n`` rows together).

    Null texts have no words; a null source is a source, the last; documents without words are drawn independently, as they weigh
    nothing; a null id is an id like others; an empty table gives an empty result.
    """
    named = docs.select(
        unit(doc_id, source, text).alias("unit"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        n_words(text).alias("size"),
    )
    firsts = [F.first(c).alias(c) for c in ("doc_id", "source", "size")]
    units = written(named.groupBy("unit").agg(*firsts, F.count(F.lit(1)).alias("n")), "units")
    targets = written(source_targets(units, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = targets.withColumn("rate", rate).withColumn("leaves", F.ceil(F.col("units") / fan)).withColumnRenamed("source", "of")
    wanted = units.join(per, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("want", F.col("n") * F.col("rate"))
    wanted = wanted.withColumn("sure", F.floor("want")).withColumn("p", F.col("want") - F.floor("want"))
    wanted = wanted.withColumn("h", F.xxhash64("unit", F.lit(seed)))
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    # a unit of n equal rows has sure or sure + 1 copies, and one copy weighs its words
    items = wanted.where(open_).select(
        F.to_json(F.struct(F.col("source").cast("string"))).alias("src"), F.pmod("h", "leaves").alias("node"), "h", "unit",
        F.col("size").cast("double").alias("words"), "p",
    )
    nodes = targets.agg(F.max(F.ceil(F.col("units") / fan))).first()[0] or 0
    decided = wanted.where(~open_).select("unit", F.when(_chance("h", F.lit(seed)) < F.col("p"), 1).otherwise(0).alias("up"))
    for level in range(1 + max(0, math.ceil(math.log(max(nodes, 1), fan) - 1e-9)) if nodes else 0):
        level_done = written(_folded(items, ["src", "node"], seed + level), "meetings")
        decided = decided.unionByName(level_done.select(F.explode("done").alias("d")).select("d.unit", "d.up"))
        items = level_done.select("src", F.floor(F.col("node") / fan).alias("node"), "held.h", "held.unit", "held.words", "held.p")
    decided = decided.unionByName(items.select("unit", F.when(_chance("h", F.lit(seed + 1)) < F.col("p"), 1).otherwise(0).alias("up")))
    done = wanted.join(decided.groupBy("unit").agg(F.max("up").alias("up")), "unit")
    return done.select("unit", "doc_id", "source", "size", "n", "source_size", "target", (F.col("sure") + F.col("up")).alias("copies"))


def _shared(place: Column) -> Column:
    """Copies of the row at ``place`` (from 1) among its unit's equal rows."""
    return (F.floor(F.col("copies") / F.col("n")) + F.when(place <= F.col("copies") % F.col("n"), 1).otherwise(0)).cast("long")


def mixed_rows(found: DataFrame) -> DataFrame:
    """Units of :func:`copies` as one row for each document: ``taken`` is the number of its words in the mix."""
    each = found.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    taken = _shared(F.col("place")) * F.col("size")
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with the columns they came with."""
    names = {k: options.get(k, k) for k in ("doc_id", "source", "text")}
    key, count, total, place, times = without(docs.columns, ["unit", "n", "copies", "place", "times"])
    found = written(copies(docs, **options).select(F.col("unit").alias(key), F.col("n").alias(count), F.col("copies").alias(total)), "copies")
    rows = docs.withColumn(key, unit(**names)).join(found.where(F.col(total) > 0), key)
    rows = rows.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    own = F.floor(F.col(total) / F.col(count)) + F.when(F.col(place) <= F.col(total) % F.col(count), 1).otherwise(0)
    rows = rows.withColumn(times, F.explode(F.sequence(F.lit(0), own.cast("int")))).where(F.col(times) > 0)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
