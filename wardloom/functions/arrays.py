"""Array expressions used for packing and batching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrapped(items: Column, start: int, end: int) -> Column:
    return F.concat(F.array(F.lit(start)), items, F.array(F.lit(end)))


def chained(lists: Column, start: int, end: int) -> Column:
    """One start marker, then every list followed by an end marker."""
    return F.concat(F.array(F.lit(start)), F.flatten(F.transform(lists, lambda x: F.concat(x, F.array(F.lit(end))))))


def pad_right(items: Column, length, value=0) -> Column:
    """Fill with ``value`` up to ``length``; a longer array is an error, never cut."""
    length = F.lit(length) if isinstance(length, int) else length
    value = value if isinstance(value, Column) else F.lit(value)
    filled = F.concat(items, F.array_repeat(value, length - F.size(items)))
    return F.when(F.size(items) <= length, filled).when(items.isNotNull(), F.raise_error(F.lit("array exceeds its fixed length")))


def one_hot(label: Column, classes: int) -> Column:
    """Label as an array of 0.0 / 1.0; a list label switches on every class it names."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("float"))


def many_hot(labels: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.array_contains(labels, i).cast("float"))
