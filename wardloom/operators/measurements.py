"""Labels binned from the mean of a measurement in the prediction window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.functions.times import instant, second_bounds
from wardloom.operators.exclusions import FIRST
from wardloom.plans.ranges import join_points_to_spans
from wardloom.spec import Band, Bins, Keys, LabTable, MeasurementTask


def binned(value: Column, rule: Bins | Band) -> Column:
    if isinstance(rule, Band):
        passed = [value >= rule.low, value > rule.high]
    elif rule.descending:
        passed = [value < c for c in rule.cuts]
    else:
        passed = [value >= c for c in rule.cuts]
    return sum((p.cast("int") for p in passed), F.lit(0))


def _task_values(labs: DataFrame, lab: LabTable, tasks: Sequence[MeasurementTask]) -> DataFrame:
    """One filtered scan for all tasks: rows of any task's items that carry a value."""
    code = F.col(lab.code)
    wanted = sorted({item for t in tasks for item in t.items}, key=str)
    # compared in the column's own type, so that the list reaches the scan; the few rows left are cast
    text = labs.schema[lab.code].dataType.simpleString() == "string"
    found = labs.where(code.isin([str(i) for i in wanted] if text else wanted) & F.col(lab.value).isNotNull())
    return found.withColumn("_item", code.try_cast("long") if all(isinstance(i, int) for i in wanted) else code)


def label_measurement(
    cohort: DataFrame,
    labs: DataFrame,
    lab: LabTable,
    tasks: Sequence[MeasurementTask],
    obs: int,
    gap: int,
    pred: int,
    keys: Keys = Keys(),
    exclusions: DataFrame | None = None,
    exclusion_key: str | None = None,
) -> DataFrame:
    """Cohort plus one integer column per task (null without a measurement in the window).

    All tasks share one scan, one join and one aggregation. With absolute times the exclusion time is carried by the cohort
    row, so the large lab table is not joined a second time. With offsets the values are summed per stay, item and minute
    before they meet the exclusions, so a stay with very many values is small by then.
    """
    first, last = (obs + gap) * 60, (obs + pred) * 60
    rows = _task_values(labs, lab, tasks)
    value = F.col(lab.value).try_cast("double")
    has_exclusion = exclusions is not None and any(t.before_exclusion for t in tasks)
    # the reference point of the window is the stay; only the columns the window needs travel into the join
    if lab.unit == "abs":
        spans = cohort
        if has_exclusion:
            spans = spans.join(exclusions.select(exclusion_key, FIRST), exclusion_key, "left")
        key = keys.admission if lab.key == "admission" else keys.stay
        spans = spans.select(*dict.fromkeys([key, keys.stay]), "intime", *([FIRST] if has_exclusion else []))
        start = F.unix_seconds("intime")
        earliest, latest = second_bounds(first, last)
        points = rows.select(
            F.col(key), "_item", value.alias("_sum"), value.isNotNull().cast("long").alias("_count"), instant(rows, lab.time).alias("_at")
        )
        matched = join_points_to_spans(
            points, spans, key, F.unix_seconds("_at"), start + earliest, start + latest, max((pred - gap) * 3600, 3600)
        )
    else:
        # minute offsets need no join to find the window; the filter runs at the scan
        at = F.col(lab.time).try_cast("int")
        inside = rows.where(at.between(first, last)).select(F.col(keys.stay), "_item", value.alias("_value"), at.alias("_at"))
        matched = inside.groupBy(keys.stay, "_item", "_at").agg(F.sum("_value").alias("_sum"), F.count("_value").alias("_count"))
        if has_exclusion:
            matched = matched.join(exclusions.select(exclusion_key, FIRST), exclusion_key, "left")
    columns = []
    for t in tasks:
        use = F.col("_item").isin(list(t.items))
        if t.before_exclusion and has_exclusion:
            use = use & (F.col(FIRST).isNull() | (F.col(FIRST) > F.col("_at")))
        mean = F.try_divide(F.sum(F.when(use, F.col("_sum"))), F.sum(F.when(use, F.col("_count"))))
        columns.append(mean.alias(t.name))
    per_stay = matched.groupBy(keys.stay).agg(*columns)
    labels = per_stay.select(keys.stay, *[binned(F.col(t.name), t.rule).alias(t.name) for t in tasks])
    return cohort.join(labels, keys.stay, "left")
