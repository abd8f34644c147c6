"""Joining points to spans without pairing everything that shares a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "_at_second"
FIRST = "_first_second"
LAST = "_last_second"
RADIX = 16  # each level's slices are so many times as wide as those of the level below; a span touches at most so many
BUCKETS = 1024
WHOLE = ("tinyint", "smallint", "int", "bigint")


def level_widths(width: int) -> list[int]:
    widths = [width]
    while widths[-1] < 1 << 56:
        widths.append(widths[-1] * RADIX)
    return widths


def _level(length: Column, widths: list[int]) -> Column:
    """The lowest level on which a span of this many seconds touches at most ``RADIX`` slices."""
    chosen = F.lit(len(widths) - 1)
    for level in reversed(range(len(widths) - 1)):
        chosen = F.when(length < (RADIX - 1) * widths[level], F.lit(level)).otherwise(chosen)
    return chosen


def _of_level(level: Column, widths: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in widths]), level + 1)


def _bucket(df: DataFrame, key: str, other: DataFrame) -> Column:
    """A number that equal keys of both sides share. Keys of kinds that are compared by more than their bytes are not told apart."""
    mine, its = (x.schema[key].dataType.simpleString() for x in (df, other))
    if mine != its and not (mine in WHOLE and its in WHOLE):
        return F.lit(0)
    value = F.col(key).cast("bigint") if mine in WHOLE else F.col(key)
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


def slice_spans(spans: DataFrame, first: Column, last: Column, width: int) -> DataFrame:
    """``spans`` once for each slice they touch, at most ``RADIX`` rows however long they are."""
    widths = level_widths(width)
    kept = spans.withColumn(FIRST, first).withColumn(LAST, last).where(F.col(FIRST) <= F.col(LAST))
    levelled = kept.withColumn("_level", _level(F.col(LAST) - F.col(FIRST), widths))
    wide = _of_level(F.col("_level"), widths)
    touched = F.sequence(F.floor(F.col(FIRST) / wide), F.floor(F.col(LAST) / wide))
    return levelled.withColumn("_slice", F.explode(touched)).withColumn("_slice", F.col("_slice") * len(widths) + F.col("_level"))


def _levels_by_bucket(spans: DataFrame, points: DataFrame, key: str, first: Column, last: Column, widths: list[int]) -> Column:
    """For each bucket of keys the levels on which its spans lie: one bounded row, whatever the number of spans."""
    kept = spans.select(_bucket(spans, key, points).alias("bucket"), first.alias(FIRST), last.alias(LAST)).where(F.col(FIRST) <= F.col(LAST))
    levels = F.collect_set(_level(F.col(LAST) - F.col(FIRST), widths)).alias("levels")
    each = kept.groupBy("bucket").agg(levels).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "levels"))).alias("m"))
    none = F.array().cast("array<int>")
    return each.select(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.coalesce(F.try_element_at("m", b), none)).alias("levels")).scalar()


def join_points_to_spans(
    points: DataFrame, spans: DataFrame, key: str, at: Column, first: Column, last: Column, width: int
) -> DataFrame:
    """Inner join of points and spans with the same ``key`` and first <= at <= last (whole seconds).

    Time is cut into slices, of ``width`` seconds on the lowest level and ``RADIX`` times as wide from level to level. A span lies on the level that its
    length asks for and is repeated once per slice it touches there, so a span of a century makes no more rows than one of a day. A point lies in
    one slice of each level on which spans of its key (or of a key in the same bucket) lie, which is one level for most and none for
    keys without spans. The equality on (key, slice) does the work: a key that owns a large part of the rows is spread over its slices, and only points
    and spans that are close in time ever meet, each pair once.
    """
    widths = level_widths(width)
    sliced = slice_spans(spans, first, last, width).drop("_level")
    levels = F.get(_levels_by_bucket(spans, points, key, first, last, widths), _bucket(points, key, spans))
    placed = points.withColumn(POINT, at).withColumn("_level", F.explode(levels))
    slice_ = F.floor(F.col(POINT) / _of_level(F.col("_level"), widths)) * len(widths) + F.col("_level")
    return (
        placed.withColumn("_slice", slice_)
        .drop("_level")
        .join(sliced, [key, "_slice"])
        .where(F.col(POINT).between(F.col(FIRST), F.col(LAST)))
        .drop("_slice", POINT, FIRST, LAST)
    )
