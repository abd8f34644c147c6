"""Time expressions. Times are compared in whole seconds, relative times are minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp; unreadable text becomes null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def whole_minutes(later: Column, earlier: Column) -> Column:
    """Minutes between two timestamps, rounded down (negative when ``later`` is the earlier one)."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(6e7)).cast("long")


def nearest_minute(at: Column, start: Column) -> Column:
    """Minutes between two timestamps, rounded half away from zero on whole seconds."""
    return F.round((F.unix_seconds(at) - F.unix_seconds(start)) / F.lit(60)).try_cast("int")


def second_bounds(first_minute: int, last_minute) -> tuple:
    """Whole-second bounds that ``nearest_minute`` maps into [first_minute, last_minute].

    Half a minute rounds away from zero, so -30 s is minute -1 but 60 m - 30 s is minute m.
    """
    lower = -29 if first_minute == 0 else first_minute * 60 - 30
    # a wrong time can lie centuries away, which is more seconds than an int holds
    last = last_minute.cast("long") if isinstance(last_minute, Column) else last_minute
    return lower, last * 60 + 29
