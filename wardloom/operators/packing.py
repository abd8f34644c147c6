"""Packed stays: hierarchical (events x tokens) and flat (tokens) forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.functions.arrays import chained, pad_right, wrapped
from wardloom.spec import Keys, TokenIds

CHANNELS = ("ids", "types", "dpes")


def _marks(t: TokenIds) -> list[tuple[str, int, int]]:
    return [
        ("ids", t.start, t.end),
        ("types", t.start_type, t.end_type),
        ("dpes", t.no_place, t.no_place),
    ]


def _events(history: Column, max_len: int, t: TokenIds, kind: str) -> Column:
    """Every event as three padded channels."""
    padded = F.transform(history, lambda e: F.array(*[pad_right(wrapped(e[c], a, b), max_len, t.pad) for c, a, b in _marks(t)]))
    return padded.cast(f"array<array<array<{kind}>>>")


def _flat(history: Column, max_len: int, t: TokenIds, kind: str) -> Column:
    # a field of an array of structs is the array of that field
    rows = [pad_right(chained(history[c], a, b), max_len, t.pad) for c, a, b in _marks(t)]
    return F.array(*rows).cast(f"array<array<{kind}>>")


def _history(*columns) -> Column:
    """Events of one stay, oldest first. The stay was cut before, so the list is bounded by the token limit."""
    return F.sort_array(F.collect_list(F.struct((-F.col("event_no")).alias("_order"), *columns)))


# ids of up to 32,767 fit the default type; for larger vocabularies pass kind="int"
def pack_hierarchical(
    events: DataFrame, max_event_tokens: int, tokens: TokenIds = TokenIds(), keys: Keys = Keys(), kind: str = "smallint"
) -> DataFrame:
    """(stay, hi, time): per event and channel the marked, padded tokens. Input: events after ``cut_history``."""
    rows = events.groupBy(keys.stay).agg(_history("time_min", *CHANNELS).alias("h"))
    return rows.select(keys.stay, _events(F.col("h"), max_event_tokens, tokens, kind).alias("hi"), F.col("h.time_min").alias("time"))


def pack_flat(
    events: DataFrame, max_stay_tokens: int, tokens: TokenIds = TokenIds(), keys: Keys = Keys(), kind: str = "smallint"
) -> DataFrame:
    """(stay, fl): one start marker, then every event and its end marker, padded, per channel."""
    rows = events.groupBy(keys.stay).agg(_history(*CHANNELS).alias("h"))
    return rows.select(keys.stay, _flat(F.col("h"), max_stay_tokens, tokens, kind).alias("fl"))


def pack_stays(
    events: DataFrame, max_event_tokens: int, max_stay_tokens: int, tokens: TokenIds = TokenIds(), keys: Keys = Keys(), kind: str = "smallint"
) -> DataFrame:
    """(stay, hi, fl, time): both forms from one grouping."""
    rows = events.groupBy(keys.stay).agg(_history("time_min", *CHANNELS).alias("h"))
    return rows.select(
        keys.stay,
        _events(F.col("h"), max_event_tokens, tokens, kind).alias("hi"),
        _flat(F.col("h"), max_stay_tokens, tokens, kind).alias("fl"),
        F.col("h.time_min").alias("time"),
    )
