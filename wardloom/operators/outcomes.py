"""Labels that follow from the cohort row alone, and class coding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.operators.cohort import DEATH

IN_UNIT = "IN_ICU_MORTALITY"
IN_HOSPITAL = "IN_HOSPITAL_MORTALITY"
NO_DISCHARGE = "No Discharge"


def _true(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def label_death_within(
    cohort: DataFrame, obs: int, gap: int, horizon: int, out: str = "mortality", include_unit_death: bool = False
) -> DataFrame:
    """1 when the patient dies after the gap and up to the end of the horizon (hours)."""
    dead = F.col("hos_discharge_location") == DEATH
    if include_unit_death:
        dead = _true(dead) | F.col("in_icu_mortality")
    left = F.col("dischtime_min")
    inside = (left > (obs + gap) * 60) & (left <= (obs + horizon) * 60)
    return cohort.withColumn(out, _true(dead & inside).cast("int"))


def label_los(cohort: DataFrame, days: int) -> DataFrame:
    return cohort.withColumn(f"los_{days}day", _true(F.col("los") > days).cast("int"))


def _hospital_death() -> Column:
    return _true(~F.col("in_icu_mortality") & (F.col("hos_discharge_location") == DEATH))


def final_acuity(cohort: DataFrame, out: str = "final_acuity") -> DataFrame:
    """Discharge class as text; a death inside or outside the unit overrides the location."""
    text = (
        F.when(F.col("in_icu_mortality"), IN_UNIT).when(_hospital_death(), IN_HOSPITAL).otherwise(F.col("hos_discharge_location"))
    )
    return cohort.withColumn(out, text)


def imminent_discharge(cohort: DataFrame, obs: int, gap: int, pred: int, out: str = "imminent_discharge") -> DataFrame:
    """Discharge class as text for stays discharged inside the prediction window (both ends included)."""
    discharged = _true(F.col("dischtime_min").between((obs + gap) * 60, (obs + pred) * 60))
    place = F.when(F.col("in_icu_mortality") | _hospital_death(), DEATH).otherwise(F.col("hos_discharge_location"))
    return cohort.withColumn(out, F.when(discharged, place).otherwise(NO_DISCHARGE))


def class_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(index, name) of the distinct classes in name order; one row for each class takes part."""
    names = df.select(F.col(col).alias("name")).where("name is not null").distinct()
    return names.select((F.row_number().over(Window.orderBy("name")) - 1).alias("index"), "name")


def encode_classes(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Replace a class text by its index (null: -1); also return the dictionary. The planner broadcasts the dictionary where its size allows
    it, and splits a class that holds most of the rows at run time otherwise; null classes stay out of the join."""
    dictionary = class_dictionary(df, col)
    known = dictionary.select(F.col("name").alias(col), F.col("index").alias("_index"))
    coded = df.where(F.col(col).isNotNull()).join(known, col).withColumn(col, F.col("_index").cast("int")).select(df.columns)
    rest = df.where(F.col(col).isNull()).withColumn(col, F.lit(-1)).select(df.columns)
    return coded.unionByName(rest), dictionary


def label_final_acuity(cohort: DataFrame) -> tuple[DataFrame, DataFrame]:
    return encode_classes(final_acuity(cohort), "final_acuity")


def label_imminent_discharge(cohort: DataFrame, obs: int, gap: int, pred: int) -> tuple[DataFrame, DataFrame]:
    return encode_classes(imminent_discharge(cohort, obs, gap, pred), "imminent_discharge")
