"""Deletion of repeated runs of lines, by a suffix array over sequences of line ids that is built by prefix doubling.

A suffix of a document is what follows from a line on. At each level k all suffixes are ranked by their first 2^k lines: pairs of ranks of the level below
are counted, the different pairs that occur more than once are sorted by range and numbered in that order. So ranks are exact and ordered, the order by
rank is the suffix array as far as 2^k lines, and a new rank begins where the longest common prefix of neighbours is less. Suffixes that nothing else
agrees with have no rank and leave the doubling; it ends where none is left.

For any depth L the ranks of the two prefixes of 2^k <= L lines that begin and end with the first L lines name the interval of the array
whose longest common prefix is at least L lines.

A run counts if it has ``min_words`` words. For every line the shortest such run that begins there and the shortest one that ends there are looked up:
a run occurs elsewhere if its interval has more than one suffix, and it is a later copy if its suffix is not the first of the interval. Every
repeated run that counts is the union of such shortest ones, so their union is exactly the later copies of all maximal repeated runs, and
whatever is deleted stands somewhere before.

Line ids are compared by content: a hash finds the lines that may recur, and where different lines share a hash, each has a number of its own beside it.

Lines that occur once cut the sequences into segments; segments with too few words go at once. Everything after that works on segments, so no task needs
a whole document or all copies of a line: counts are combined in the tasks, and what the rows are joined to says how many of them each key has, so that
the keys of many rows go to every task. Lines without words, the most frequent of all, are not looked up at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import filled, joined_by_size, without, words_of, written
from wardloom.plans.hot import join_counted


def line_hash(line: Column) -> Column:
    return F.xxhash64(line, F.char_length(line))


@dataclass(frozen=True)
class Runs:
    """``hashed``: what finds lines that may be alike; results do not depend on it."""

    min_words: int = 50
    hashed: Callable[[Column], Column] = line_hash


def line_table(docs: DataFrame, key: str, doc_id: str, text: str, hashed: Callable[[Column], Column] = line_hash) -> DataFrame:
    """(uid, doc_id, pos, line, h, w) of every line: its hash and its number of words."""
    lines = F.posexplode(F.split(filled(F.col(f"`{text}`")), "\n")).alias("pos", "line")
    rows = docs.select(F.col(f"`{key}`").alias("uid"), F.col(f"`{doc_id}`").alias("doc_id"), lines)
    return rows.select("uid", "doc_id", "pos", "line", hashed(F.col("line")).cast("long").alias("h"), F.size(words_of(F.col("line"))).alias("w"))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(uid, doc_id, pos, h, twin, w): lines without words, and those whose hash occurs more than once. (h, twin) is the same for the same
    content only: ``twin`` numbers the different lines of one hash, 0 where there is only one."""
    often = written(lines.where("w > 0").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    blank = lines.where("w = 0")
    contents = join_counted(lines.where("w > 0").select("h", "line"), often, "h", "n").unionByName(blank.select("h", "line")).distinct()
    # different lines of one hash are few: about n^2 / 2^65 hashes of n lines have any
    twins = contents.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("line")).alias("twins")).where("n > 1").drop("n")
    told = joined_by_size(lines, written(twins, "twins"), ["h"], "left")
    told = told.select("uid", "doc_id", "pos", "h", F.coalesce(F.array_position("twins", F.col("line")), F.lit(0)).alias("twin"), "w")
    return join_counted(told.where("w > 0"), often, "h", "n").unionByName(told.where("w = 0"))


def segments(kept: DataFrame, min_words: int) -> DataFrame:
    """(uid, doc_id, seg, pos, h, twin, w, ends): repeated lines in segments with enough words; ``ends`` is the running number of words."""
    in_doc = Window.partitionBy("uid").orderBy("pos")
    kept = kept.withColumn("seg", F.col("pos") - F.row_number().over(in_doc))
    in_seg = Window.partitionBy("uid", "seg")
    up = in_seg.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = kept.withColumn("all", F.sum("w").over(in_seg)).withColumn("ends", F.sum("w").over(up))
    return kept.where(F.col("all") >= min_words).select("uid", "doc_id", "seg", "pos", "h", "twin", "w", "ends")


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(uid, doc_id, first, last): for every line the shortest run of enough words that begins there, and that ends there; each once."""
    begins = F.col("ends") - F.col("w")
    end_at = lines.select("uid", "doc_id", "seg", "pos", F.lit("end").alias("kind"), F.col("ends").alias("at"))
    wanted = lines.select("uid", "doc_id", "seg", "pos", F.lit("want").alias("kind"), (begins + min_words).alias("at"))
    # downwards the last end before a want is the nearest one at or beyond it; of lines without words the first
    down = Window.partitionBy("uid", "seg").orderBy(F.col("at").desc(), "kind", F.col("pos").desc())
    last = F.last(F.when(F.col("kind") == "end", F.col("pos")), ignorenulls=True).over(down)
    forward = end_at.unionByName(wanted).withColumn("last", last).where("kind = 'want' AND last IS NOT NULL")
    start_at = lines.select("uid", "doc_id", "seg", "pos", F.lit("begin").alias("kind"), begins.alias("at"))
    wanted = lines.select("uid", "doc_id", "seg", "pos", F.lit("want").alias("kind"), (F.col("ends") - min_words).alias("at"))
    up = Window.partitionBy("uid", "seg").orderBy("at", "kind", "pos")
    first = F.last(F.when(F.col("kind") == "begin", F.col("pos")), ignorenulls=True).over(up)
    backward = start_at.unionByName(wanted).withColumn("first", first).where("kind = 'want' AND first IS NOT NULL")
    both = forward.select("uid", "doc_id", F.col("pos").alias("first"), "last")
    both = both.unionByName(backward.select("uid", "doc_id", "first", F.col("pos").alias("last")))
    return both.dropDuplicates()


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` whose ``pair`` occurs more than once, with the ``rank`` of the pair among these instead of it: numbers in the order of the pairs."""
    rows = written(rows.where("pair IS NOT NULL"), "pairs")
    counted = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # sorted by range, the number of a row is the running count inside its range, with the range before it
    ordered = counted.repartitionByRange("pair").sortWithinPartitions("pair").withColumn("rank", F.monotonically_increasing_id())
    return join_counted(rows, written(ordered, "ranks"), "pair", "n").drop("pair")


def suffix_ranks(lines: DataFrame, levels: int) -> DataFrame:
    """(uid, pos, k, rank): the rank of every suffix by its first 2^k lines, for all levels below ``levels``; suffixes that differ from all others, or
    whose segment ends before, have none."""
    level = written(ranked(lines.select("uid", "seg", "pos", F.struct("h", "twin").alias("pair"))), "level")
    found = level.withColumn("k", F.lit(0))
    for k in range(levels - 1):
        if level.isEmpty():
            break
        ahead = Window.partitionBy("uid", "seg").orderBy("pos").rangeBetween(1 << k, 1 << k)
        paired = level.withColumn("next", F.first("rank").over(ahead))
        pair = F.when(F.col("next").isNotNull(), F.struct("rank", "next")).alias("pair")
        level = written(ranked(paired.select("uid", "seg", "pos", pair)), "level")
        found = found.unionByName(level.withColumn("k", F.lit(k + 1)))
    return found.select("uid", "pos", "k", "rank")


def later_copies(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", runs: Runs = Runs()) -> DataFrame:
    """(uid, copies): for each document with later copies the maximal runs of lines (first, last) that are to go. ``key`` is unique in ``docs``.

    The order of documents is by id, null ids last, and by key among equal ids; inside a document by line.
    """
    lines = written(line_table(docs, key, doc_id, text, runs.hashed), "lines", compression="zstd")
    held = written(segments(repeated_lines(lines), runs.min_words), "segments")
    # the greatest power of two within the depth
    depth = F.col("last") - F.col("first") + 1
    found = written(shortest_runs(held, runs.min_words).withColumn("depth", depth).withColumn("k", F.length(F.bin("depth")) - 1), "runs")
    deepest = found.agg(F.max("depth")).first()[0] or 1
    ranks = suffix_ranks(held, deepest.bit_length())
    heads = ranks.select("uid", F.col("pos").alias("first"), "k", F.col("rank").alias("head"))
    tails = ranks.select("uid", F.col("pos").alias("tail_at"), "k", F.col("rank").alias("tail"))
    half = F.expr("CAST(shiftleft(1L, CAST(k AS INT)) AS INT)")
    named = found.withColumn("tail_at", F.col("last") - half + 1).join(heads, ["uid", "first", "k"]).join(tails, ["uid", "tail_at", "k"])
    named = written(named.select("uid", "doc_id", "first", "last", F.struct("depth", "head", "tail").alias("interval")), "intervals")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "first")
    firsts = named.groupBy("interval").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = join_counted(named, written(firsts, "firsts"), "interval", "n")
    copies = met.where(place > F.col("earliest")).select("uid", "first", "last")
    # islands: runs that overlap or touch are one
    ordered = Window.partitionBy("uid").orderBy("first", "last")
    reach = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = copies.withColumn("new", F.when(F.col("first") <= reach + 1, 0).otherwise(1))
    islands = marked.withColumn("island", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = islands.groupBy("uid", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("copies"))


def _left(text: Column, copies: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x, i: ~F.exists(copies, lambda r: (i >= r["first"]) & (i <= r["last"])))
    return F.array_join(lines, "\n")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", runs: Runs = Runs()) -> DataFrame:
    """``row`` (all columns as they came), ``text`` without later copies, ``copies`` (the deleted runs, from line 0) and ``emptied``: no word is
    left of a text that had some.

    Null texts stay null and have no lines to compare; repeated rows are documents of their own, so all but the first lose what counts;
    an empty table gives an empty result.
    """
    key = without(docs.columns, ["uid"])[0]
    rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "documents", compression="zstd")
    found = later_copies(rows, key, doc_id, text, runs)
    joined = rows.select(F.col(key).alias("uid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(found, "uid", "left")
    body = F.col("row").getField(text)
    left = F.when(F.col("copies").isNull(), body).otherwise(_left(body, F.col("copies")))
    none = F.array().cast("array<struct<first:int,last:int>>")
    result = joined.select("row", left.alias("text"), F.coalesce("copies", none).alias("copies"))
    return result.withColumn("emptied", (F.size("copies") > 0) & ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))


