"""Running totals over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled_position(key: Column, seed: int | Column) -> Column:
    """A reproducible random position for ``key``: the hex digest of key and seed."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.md5(F.concat_ws(":", key.cast("string"), seed.cast("string")).cast("binary"))


def running_total(
    rows: DataFrame, position: str, amount: str, out: str = "running", total: str = "total", within: Sequence[str] = (),
    hex_digits: int = 3,
) -> DataFrame:
    """Add the inclusive running sum of ``amount`` in ``position`` order, and the grand total.

    ``position`` is a hex digest, so its first ``hex_digits`` digits cut the order into equal buckets (4096 for three): bucket sums first
    (pre-aggregated in every task), offsets over the buckets, then a window inside each bucket.
    """
    placed = rows.withColumn("_bucket", F.substring(position, 1, hex_digits))
    groups = [*within, "_bucket"]
    sums = placed.groupBy(*groups).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *groups,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(Window.partitionBy(*within)).alias(total),
    )
    inside = Window.partitionBy(*groups).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the planner knows how small the offsets are; it splits nothing that a bucket of the digest made even
    numbered = placed.withColumn("_inside", F.sum(amount).over(inside)).join(offsets, groups)
    return numbered.withColumn(out, F.col("_before") + F.col("_inside")).drop("_bucket", "_inside", "_before")
