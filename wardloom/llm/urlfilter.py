"""URL filters: longest rule first, then exact membership of the host in a block list by a cascade of Bloom filters.

A Bloom filter never misses a listed key but passes some others. The keys that can be asked for are known, they are those of the
corpus, so the others that pass can be counted: a second filter holds them, a third holds the listed keys that pass the second, and
so on until a level passes nobody wrongly. The first level that does not hold a key decides. The answer is exact for every key of the universe, takes a
few bits for each listed key, and needs no join: the levels are one row, read by every task as a constant.

Their size is known before they are built. Beyond ``most_bits`` the list is joined instead, with the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    """``bits`` of a filter and its number of hash functions."""

    bits: int
    hashes: int


@dataclass(frozen=True)
class Cascade:
    """Levels, and a table of one row with their words: ``words array<array<bigint>>``."""

    levels: tuple[Level, ...]
    words: DataFrame

    def holds(self, key: Column) -> Column:
        """Whether ``key`` is listed; exact for the keys of the universe. Null keys are not."""
        if not self.levels:
            return F.lit(False)
        all_words = self.words.scalar()
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(~_passes(key, i, self.levels[i], F.get(all_words, F.lit(i))), F.lit(i % 2 == 1)).otherwise(answer)
        return F.coalesce(key.isNotNull() & answer, F.lit(False))


def _positions(key: Column, number: int, level: Level) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(j)), F.lit(level.bits)) for j in range(level.hashes)]


def _passes(key: Column, number: int, level: Level, words: Column) -> Column:
    tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in _positions(key, number, level)]
    passed = tests[0]
    for test in tests[1:]:
        passed = passed & test
    return passed


def _sized(keys: int, wrong: float) -> Level:
    """The usual size for so many keys at this share of wrong answers."""
    hashes = max(1, round(math.log2(1 / wrong)))
    return Level(64 * max(1, math.ceil(keys * hashes / math.log(2) / 64)), hashes)


def _filled(keys: DataFrame, number: int, level: Level) -> DataFrame:
    """One row: the filter's words. Bits are united in the tasks before they move."""
    at = F.explode(F.array(*_positions(F.col("key"), number, level)))
    bits = keys.select(at.alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("bits"))
    empty = keys.sparkSession.range(level.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return words.agg(F.transform(in_order, lambda x: x["bits"]).alias("words"))


def build_cascade(listed: DataFrame, universe: DataFrame, most_bits: int = 1 << 29) -> Cascade | None:
    """The cascade of ``listed`` (key) over ``universe`` (key); None if its first level alone would take more than ``most_bits``.

    Null keys and repeated keys count for nothing. An empty list gives a cascade without levels.
    """
    yes = written(listed.select("key").where("key IS NOT NULL").distinct(), "listed")
    no = written(universe.select("key").where("key IS NOT NULL").distinct().join(yes, "key", "left_anti"), "unlisted")
    n_yes, n_no = yes.count(), no.count()
    levels: list[Level] = []
    rows: DataFrame | None = None
    inside, outside, held = yes, no, n_yes
    while held:
        number = len(levels)
        wrong = min(0.5, max(1e-9, n_yes / (math.sqrt(2) * max(n_no, 1)))) if number == 0 else 0.5
        level = _sized(held, wrong)
        if level.bits > most_bits:
            return None
        levels.append(level)
        words = written(_filled(inside, number, level).select(F.lit(number).alias("level"), "words"), "level")
        rows = words if rows is None else rows.unionByName(words)
        inside, outside = written(outside.where(_passes(F.col("key"), number, level, words.select("words").scalar())), "passing"), inside
        held = inside.count()
    schema = "level int, words array<bigint>"
    rows = rows if rows is not None else yes.sparkSession.createDataFrame([], schema)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("level", "words"))), lambda x: x["words"])
    return Cascade(tuple(levels), written(rows.agg(in_order.alias("words")), "cascade"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, "://([^/?#]*)([^?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(whole, "://([^/?#]*)([^?#]*)", 2)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null; among equally long ones the first by text, a block before an allow.

    A rule fits its host and all subdomains of it, if the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict != "block"), reverse=True):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def filter_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", carry: Sequence[str] = ("page_id",),
                most_bits: int = 1 << 29) -> DataFrame:
    """``row`` (the carried columns), host, path, rule and verdict of every page. ``listed`` (key) are hosts to block.

    Null urls and urls without ``://`` have empty host and path: no rule fits and no list holds them, so they are allowed.
    """
    host, path = url_parts(F.col(f"`{url}`"))
    named = pages.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), host.alias("host"), path.alias("path"))
    cascade = build_cascade(listed, named.where("host <> ''").select(F.col("host").alias("key")), most_bits)
    if cascade is None:
        known = listed.select(F.col("key").alias("host"), F.lit(True).alias("found")).distinct()
        named = named.join(known, "host", "left").withColumn("found", F.coalesce("found", F.lit(False)))
    else:
        named = named.withColumn("found", cascade.holds(F.col("host")))
    ruled = named.withColumn("by", longest_rule(rules, F.col("host"), F.col("path")))
    verdict = F.coalesce("by.verdict", F.when(F.col("found"), "block").otherwise("allow"))
    return ruled.select("row", "host", "path", F.col("by.rule").alias("rule"), verdict.alias("verdict"))
