"""Events meet stays: by stay, by admission and time range, and the observation window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.functions.times import instant, nearest_minute, second_bounds
from wardloom.plans.hot import join_hot
from wardloom.plans.ranges import join_points_to_spans
from wardloom.spec import Keys

DAY = 86400


def attach_by_stay(events: DataFrame, cohort: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Events of cohort stays, with the stay's intime and outtime. No hint: the planner broadcasts a cohort
    whose size allows it, and splits an oversized stay at run time otherwise."""
    stays = cohort.select(keys.stay, "intime", "outtime_min")
    return events.join(stays, keys.stay)


def attach_by_admission(
    events: DataFrame,
    cohort: DataFrame,
    time: str,
    keys: Keys = Keys(),
    horizon_min: int | None = None,
    slice_seconds: int = DAY,
) -> DataFrame:
    """Events that carry no stay key go to every stay of their admission whose time range holds them.

    ``horizon_min`` narrows the range to the minutes that a later step will look at anyway.
    """
    stays = cohort.select(keys.admission, keys.stay, "intime", "outtime_min")
    return _attach_range(events, stays, keys.admission, time, F.col("outtime_min"), horizon_min, slice_seconds)


def attach_observed(
    events: DataFrame, cohort: DataFrame, time: str, obs: int, keys: Keys = Keys()
) -> DataFrame:
    """Absolute-time events inside the observation window of their stay, by stay key if the table has one,
    else by admission and stay range. By stay the rows are dealt by the stay alone, so whatever follows for the stay needs no other exchange;
    an oversized stay is split at run time. By admission one slice per window length keeps a stay's rows in two or three slices."""
    stays = cohort.select(keys.admission, keys.stay, "intime", "outtime_min")
    if keys.stay in events.columns:
        # the window is the time range, so outtime plays no part here
        earliest, latest = second_bounds(0, F.lit(obs * 60))
        timed = events.drop(keys.admission).withColumn(time, instant(events, time)).join(stays.drop(keys.admission), keys.stay)
        return timed.where(F.unix_seconds(time).between(F.unix_seconds("intime") + earliest, F.unix_seconds("intime") + latest))
    return _attach_range(events, stays, keys.admission, time, F.col("outtime_min"), obs * 60, obs * 3600)


def _attach_range(
    events: DataFrame, stays: DataFrame, key: str, time: str, end_min: Column, horizon_min: int | None, slice_seconds: int
) -> DataFrame:
    end = end_min if horizon_min is None else F.when(end_min.isNotNull(), F.least(end_min, F.lit(horizon_min)))
    earliest, latest = second_bounds(0, end)
    start = F.unix_seconds("intime")
    timed = events.withColumn(time, instant(events, time))
    return join_points_to_spans(
        timed, stays, key, F.unix_seconds(time), start + earliest, start + latest, slice_seconds
    )


def observation_window(events: DataFrame, obs: int, unit: str, time: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Add ``time_min`` (minutes from the start of the stay), keep 0..obs hours, drop ``exclude``.

    ``abs`` events need ``intime`` and lose their timestamp; ``min`` events keep the offset as a feature.
    """
    if unit == "abs":
        minute = nearest_minute(instant(events, time), F.col("intime"))
        out = events.withColumn("time_min", minute).drop(time, *exclude)
    elif unit == "min":
        out = events.withColumn("time_min", F.col(time).try_cast("int")).drop(*[c for c in exclude if c != time])
    else:
        raise ValueError(f"unknown time unit {unit!r}")
    return out.where(F.col("time_min").between(0, obs * 60)).drop("intime", "outtime_min")


def describe_codes(events: DataFrame, dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """Replace each code column by its text. A dictionary is (code, text), one row per code; unknown codes become null. A code that owns most
    rows is split, for which the events are scanned once before."""
    out = events
    for col, dictionary in dictionaries.items():
        # an unknown code finds nothing, so no left row is lost and none is doubled; null codes stay out of the join
        texts = dictionary.select(F.col("code").alias(col), F.col("text").alias("_text"))
        text = dictionary.schema["text"].dataType
        coded = join_hot(out.where(F.col(col).isNotNull()), texts, [col], "left").withColumn(col, F.col("_text")).select(events.columns)
        out = coded.unionByName(out.where(F.col(col).isNull()).withColumn(col, F.lit(None).cast(text)).select(events.columns))
    return out.select(events.columns)
