"""The most recent part of each stay, within event and token limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.plans.hot import row_hash
from wardloom.spec import Keys


def _latest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() for c in order]


def _stay_window(stay: str, order: Sequence[str]):
    return Window.partitionBy(stay).orderBy(*_latest_first(order))


def latest_events(events: DataFrame, count: int, order: Sequence[str], keys: Keys = Keys(), out: str = "event_no") -> DataFrame:
    """The last ``count`` events of every stay, numbered from the latest (1).

    A stay is dealt to as many parts as a shuffle has partitions, by a hash of its rows, and each part keeps its last ``count``; of these, at most
    parts x ``count`` rows a stay, the last are taken. So no task sorts a stay that owns a third of all rows, whatever ``count`` is. Within
    ``spark.sql.optimizer.windowGroupLimitThreshold`` tasks also drop what cannot be among the last before either shuffle.
    """
    part, nth = "_part", "_nth"
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.withColumn(part, F.pmod(row_hash(events), F.lit(parts)))
    own = Window.partitionBy(keys.stay, part).orderBy(*_latest_first(order))
    near = dealt.withColumn(nth, F.row_number().over(own)).where(F.col(nth) <= count).drop(part, nth)
    return near.withColumn(out, F.row_number().over(_stay_window(keys.stay, order))).where(F.col(out) <= count)


def event_limit(max_tokens: int, max_events: int | None) -> int:
    """Every event takes at least its end marker, so the token limit also bounds the number of events."""
    return max_tokens - 1 if max_events is None else min(max_events, max_tokens - 1)


def fit_tokens(
    numbered: DataFrame,
    max_tokens: int,
    min_events: int,
    order: Sequence[str],
    tokens: Column | None = None,
    keys: Keys = Keys(),
) -> DataFrame:
    """Longest run of latest events whose tokens (each event plus its end marker, plus one start marker) fit ``max_tokens``;
    stays left with ``min_events`` or fewer are dropped. Input: events after ``latest_events``, whose shuffle and sort it shares.
    """
    size = F.size("ids") if tokens is None else tokens
    running = _stay_window(keys.stay, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = numbered.withColumn("_used", F.sum(size + 1).over(running)).where(F.col("_used") <= max_tokens - 1)
    whole = fitting.withColumn("_n", F.count("*").over(Window.partitionBy(keys.stay)))
    return whole.where(F.col("_n") > min_events).drop("_used", "_n")


def cut_history(
    events: DataFrame,
    max_tokens: int,
    max_events: int | None,
    min_events: int,
    order: Sequence[str],
    tokens: Column | None = None,
    keys: Keys = Keys(),
) -> DataFrame:
    """At most ``max_events`` latest events of each stay, as far as they fit ``max_tokens``."""
    latest = latest_events(events, event_limit(max_tokens, max_events), order, keys)
    return fit_tokens(latest, max_tokens, min_events, order, tokens, keys)
