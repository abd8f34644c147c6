"""Event rows as ordered (column, value) units, and the union of event tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_columns(columns: Sequence[str], skip: Sequence[str]) -> list[str]:
    """Columns that become features, in file order."""
    return [c for c in columns if c not in set(skip)]


def event_units(events: DataFrame, columns: Sequence[str], out: str = "units", names: bool = True) -> DataFrame:
    """Add an array of (pos, name, value) for the non-null ``columns``, in the order given; without ``names`` of (pos, value), for rows
    that travel: the position says the name."""
    pairs = []
    for i, c in enumerate(columns):
        name = [F.lit(c).alias("name")] if names else []
        pairs.append(F.struct(F.lit(i).alias("pos"), *name, F.col(c).cast("string").alias("value")))
    kind = f"array<struct<pos:int,{'name:string,' if names else ''}value:string>>"
    return events.withColumn(out, F.filter(F.array(*pairs).cast(kind), lambda u: u.value.isNotNull()))


def union_events(tables: Sequence[DataFrame]) -> DataFrame:
    """All events with ``table_no``, their table's position; columns meet by name."""
    return reduce(DataFrame.unionByName, [t.withColumn("table_no", F.lit(i)) for i, t in enumerate(tables)])
