"""Equality joins in which one key may own a large part of the rows.

Keys that own many rows are found by a bounded sketch in one scan of the rows. Their rows are dealt to as many pieces as their share calls for, by
a hash of the whole row, so that a task that runs again deals them alike. The lookup side repeats its rows for
these few keys only; all other keys are one piece. Nothing here depends on a broadcast or on splitting at run time.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT = 256  # keys of one table that can be split
TRACKED = 10_000  # keys that the sketch holds in each task
FINENESS = 8  # pieces for each share of a key that fills a partition: few enough to repeat, many enough to spread evenly
HASH, PIECE = "_hot_hash", "_hot_piece"

Hot = Mapping[int, int]  # pieces of each hot key, by the hash of the key


def key_hash(*keys: Column | str) -> Column:
    return F.xxhash64(*keys)


def _pieces(top: Sequence, n: int, partitions: int) -> dict[int, int]:
    found = {r["item"]: math.ceil(FINENESS * partitions * r["count"] / n) for r in top or () if r["item"] is not None}
    return {h: pieces for h, pieces in found.items() if pieces > FINENESS // 2}


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, *keys: Column | str) -> dict[int, int]:
    """Keys whose rows fill a good part of a shuffle partition, from one scan. Null keys find nothing in a join and are not counted."""
    hashed = rows.where(_known(keys)).select(key_hash(*keys).alias(HASH))
    found = hashed.agg(F.expr(f"approx_top_k({HASH}, {KEPT}, {TRACKED})").alias("top"), F.count(HASH).alias("n")).first()
    return _pieces(found["top"], found["n"], _partitions(rows)) if found["n"] else {}


def _known(keys: Sequence[Column | str]) -> Column:
    known = F.lit(True)
    for key in keys:
        known = known & (F.col(key) if isinstance(key, str) else key).isNotNull()
    return known


def row_hash(df: DataFrame) -> Column:
    """A hash of all that a row holds, but for maps."""
    hashable = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashable], F.lit(1))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def join_hot(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", hot: Hot | None = None) -> DataFrame:
    """``rows.join(lookup, on, how)`` for an inner, left or left semi join with hot keys split; ``hot``: what is known of them already."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"cannot split a {how!r} join")
    on = list(on)
    hot = hot_keys(rows, *on) if hot is None else hot
    if not hot:
        return rows.join(lookup, on, how)
    of = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x).cast("long") for pair in hot.items() for x in pair]), key_hash(*on)), F.lit(1).cast("long"))
    dealt = rows.withColumn(PIECE, F.pmod(row_hash(rows), of))
    repeated = lookup.withColumn(PIECE, F.explode(F.sequence(F.lit(0).cast("long"), of - 1)))
    return dealt.join(repeated, [*on, PIECE], how).drop(PIECE)


def least_count(lookup: DataFrame, count: str, most_rows: int) -> int:
    """A power of two that at most ``most_rows`` rows of ``lookup`` reach with their ``count``."""
    power = F.floor(F.log2(count)).alias("power")
    rows = {r["power"]: r["n"] for r in lookup.where(F.col(count) > 0).groupBy(power).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = max(rows, default=0) + 1, 0
    while least > 0 and held + rows.get(least - 1, 0) <= most_rows:
        least -= 1
        held += rows.get(least, 0)
    return 1 << least


def join_counted(rows: DataFrame, lookup: DataFrame, on: str, count: str, how: str = "inner", most_rows: int = 250_000) -> DataFrame:
    """``rows.join(lookup, on, how)`` (inner or left) without ``count``, which says how many rows each unique key of ``lookup`` meets.

    The keys that most rows have are sent to every task, at most ``most_rows`` of them by the choice of the least count. Only rows of other keys move, and
    no such key has many. Rows of null keys stay where they are. Both sides are read twice where keys are left over, so they should be written tables.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot split a {how!r} join")
    least = least_count(lookup, count, most_rows)
    hit = "_hot_hit"
    often = lookup.where(F.col(count) >= least).drop(count).withColumn(hit, F.lit(True))
    if least == 1:
        return rows.join(F.broadcast(often), on, how).drop(hit)
    if often.isEmpty():  # very many keys have as many rows as any, so none has a large part of them
        return rows.join(lookup.drop(count), on, how)
    marked = rows.join(F.broadcast(often), on, "left")
    seldom = rows.join(F.broadcast(often.select(on)), on, "left_anti").where(F.col(on).isNotNull())
    found = marked.where(F.col(hit) if how == "inner" else F.coalesce(F.col(hit), F.col(on).isNull())).drop(hit)
    return found.unionByName(seldom.join(lookup.where(F.col(count) < least).drop(count), on, how))
