"""Greedy word pieces by joins with a vocabulary table: every different word is cut once, however often it occurs.

Every letter of a word may begin a piece. A start is a frontier: it asks for spans of 1 letter, of 2 and 3, of 4 to 7 and so on, and goes on to the
next group only while the shortest of its spans begins some entry of the vocabulary, as the prefixes of entries of that length tell. A start so makes
at most twice as many spans as the longest entry it agrees with has letters, and carries no more of its word than the longest entry could use.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.sources.stage import cut_lineage

CONTINUED = "##"


def check_vocabulary(entries: DataFrame) -> DataFrame:
    """The (token, id) rows of a vocabulary, written, as they are read several times; a token that is null or stands twice, or a null id, is an error."""
    rows = cut_lineage(entries.select("token", F.col("id").cast("int").alias("id")))
    found = rows.agg(F.count("*"), F.count("token"), F.count_distinct("token"), F.count("id")).first()
    if len(set(found)) > 1:
        raise ValueError("a vocabulary has every token once, and tokens and ids are not null")
    return rows


def _walk(size: Column, steps: Column) -> Column:
    """Ids along the longest entries from the first letter to the last; null if the way ends before. ``steps`` are in the order of their starts, the
    longest first."""

    def advance(walk, step):
        more = F.struct((F.lit(1) - step["back"]).alias("next"), F.concat(walk["ids"], F.array(step["id"])).alias("ids"))
        return F.when(walk["next"] == step["first"], more).otherwise(walk)

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("ids"))
    return F.aggregate(steps, start, advance, lambda w: F.when(w["next"] == size + 1, w["ids"]))


def _marked(first: Column, part: Column) -> Column:
    return F.when(first == 1, part).otherwise(F.concat(F.lit(CONTINUED), part))


MOST_ENTRIES = 250_000  # entries, or their prefixes, that are sent to every task


def _sent(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= MOST_ENTRIES else rows


def _asked(open_words: DataFrame, entries: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The spans of (key, word) that may be entries, as ``key, first, last, token`` (``last`` is the place of the last letter, from 1), in groups by their
    length, each with the entries of that length."""
    marks = len(CONTINUED)
    continues = F.startswith("token", F.lit(CONTINUED)) & (F.length("token") > marks)
    # an entry that begins with the mark continues a word, and may also stand at the start of one that is spelled so
    sides = entries.select("token", F.explode(F.when(continues, F.array(F.lit(0), F.lit(marks))).otherwise(F.array(F.lit(0)))).alias("mark"))
    longest = sides.agg(F.max(F.length("token") - F.col("mark"))).first()[0] or 0
    first, tail = F.col("first"), F.col("tail")
    size = F.length("word")
    starts = open_words.where((size > 0) & F.lit(longest > 0)).select("key", "word", F.explode(F.sequence(F.lit(1), size)).alias("first"))
    level = starts.select("key", "first", F.substring(F.col("word"), first, F.lit(longest)).alias("tail"))
    length = 1
    while True:
        here = F.sequence(F.lit(length), F.least(F.length(tail), F.lit(2 * length - 1)))
        asked = level.select("key", "first", "tail", F.explode(here).alias("n"))
        token = _marked(first, F.substring(tail, F.lit(1), F.col("n")))
        within = [F.length("token").between(length, 2 * length - 1), continues & (F.length("token") - marks).between(length, 2 * length - 1)]
        yield asked.select("key", "first", (first + F.col("n") - 1).alias("last"), token.alias("token")), entries.where(within[0] | within[1])
        length *= 2
        if length > longest:
            return
        prefixes = sides.where(F.length("token") - F.col("mark") >= length).select(F.substring(F.col("token"), F.lit(1), F.col("mark") + length).alias("token")).distinct()
        going = level.where(F.length(tail) >= length).withColumn("token", _marked(first, F.substring(tail, F.lit(1), F.lit(length))))
        level = cut_lineage(going.join(_sent(prefixes, prefixes.count()), "token", "left_semi").drop("token"))
        if level.isEmpty():
            return


def spans(open_words: DataFrame, entries: DataFrame) -> DataFrame:
    """``key, first, last, token``: the spans of (key, word) that may be entries. ``last`` is the place of the last letter, from 1."""
    return reduce(DataFrame.unionByName, [asked for asked, _ in _asked(open_words, entries)])


def _matches(open_words: DataFrame, entries: DataFrame) -> DataFrame:
    """``key, first, last, id``: the spans that are entries. Short spans are most of all, and short entries few: these are sent to every task."""
    groups = [asked.join(_sent(those, those.count()), "token") for asked, those in _asked(open_words, entries)]
    return reduce(DataFrame.unionByName, [g.select("key", "first", "last", "id") for g in groups])


def word_table(words: DataFrame, entries: DataFrame, unknown: int, max_word_chars: int | None = None) -> DataFrame:
    """(word, ids, n) of the distinct words of ``words`` (word), each with its number of rows: the longest entry first, then the longest continuation,
    and so on.

    A word that cannot be finished this way is the unknown id; with ``max_word_chars`` also one that is longer and no entry itself. Spans of words meet the
    vocabulary in equality joins by length, and a word's spans are combined in the tasks before they move; neither side reaches the driver, but for entries of lengths
    that are few.
    """
    distinct = words.select("word").where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    joined = distinct.join(entries.select(F.col("token").alias("word"), "id"), "word", "left")
    whole = cut_lineage(joined.withColumn("key", F.monotonically_increasing_id()))  # written, so a word keeps its key
    open_ = whole.where("id IS NULL" if max_word_chars is None else f"id IS NULL AND length(word) <= {int(max_word_chars)}").select("key", "word")
    step = F.struct("first", (-F.col("last")).alias("back"), "id")
    steps = _matches(open_, entries).groupBy("key").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    walked = F.coalesce(_walk(F.length("word"), F.col("steps")), F.array(F.lit(unknown)))
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(walked)
    return whole.join(steps, "key", "left").select("word", ids.alias("ids"), "n")
