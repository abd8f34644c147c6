"""Stays: one common schema from several layouts, selection, first and last stay of an admission."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.functions.times import instant, whole_minutes
from wardloom.spec import Keys, StayLayout

DEATH = "Death"


def recode(text: Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary recode; a text outside the mapping becomes null."""
    out = F.lit(None).cast("string")
    for target in dict.fromkeys(mapping.values()):
        out = F.when(text.isin([k for k, v in mapping.items() if v == target]), target).otherwise(out)
    return out


def _as_long(df: DataFrame, name: str) -> Column:
    """The column as it is if it is long already: filters on it then reach the scan."""
    return F.col(name) if df.schema[name].dataType.simpleString() == "bigint" else F.col(name).cast("string").try_cast("long")


def _age_at(birth: Column, at: Column) -> Column:
    before_birthday = F.date_format(at, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(at) - F.year(birth) - before_birthday.cast("int")


def normalize_stays(
    stays: DataFrame, layout: StayLayout, patients: DataFrame | None = None, admissions: DataFrame | None = None
) -> DataFrame:
    """Stays of any layout in the common cohort schema (one row per stay).

    The patient and admission sides are one row per key, so neither join multiplies stays.
    """
    if layout.mode == "capped":
        return _offset_stays(stays, layout)
    if layout.mode not in ("birthdate", "anchor"):
        raise ValueError(f"unknown layout mode {layout.mode!r}")

    base = stays.select(
        _as_long(stays, layout.stay).alias("stay_id"),
        _as_long(stays, layout.admission).alias("hadm_id"),
        _as_long(stays, layout.patient).alias("patient_id"),
        F.col(layout.los).try_cast("double").alias("los"),
        instant(stays, layout.intime).alias("intime"),
        instant(stays, layout.outtime).alias("_out"),
        *[F.col(c).alias(n) for c, n in zip(layout.units or (), ("first_unit", "last_unit"))],
    )
    if layout.mode == "birthdate":
        people = patients.select(_as_long(patients, layout.patient).alias("patient_id"), instant(patients, layout.birth_date).alias("_born"))
        age = _age_at(F.col("_born"), F.col("intime"))
    else:
        people = patients.select(
            _as_long(patients, layout.patient).alias("patient_id"),
            F.col(layout.anchor_year).try_cast("int").alias("_year"),
            F.col(layout.anchor_age).try_cast("int").alias("_age"),
        )
        age = F.year("intime") - F.col("_year") + F.col("_age")
    visits = admissions.select(
        _as_long(admissions, layout.admission).alias("hadm_id"),
        instant(admissions, layout.dischtime).alias("_left"),
        F.col(layout.location).alias("_place"),
    )
    place = F.when(F.col("_place") == layout.died, DEATH).otherwise(F.col("_place"))
    died_inside = (F.col("intime") < F.col("_left")) & (F.col("_left") <= F.col("_out")) & (place == DEATH)
    return (
        base.join(people, "patient_id", "left")
        .join(visits, "hadm_id", "left")
        .select(
            "stay_id",
            "hadm_id",
            "patient_id",
            "los",
            age.cast("int").alias("age"),
            "intime",
            whole_minutes(F.col("_out"), F.col("intime")).alias("outtime_min"),
            whole_minutes(F.col("_left"), F.col("intime")).alias("dischtime_min"),
            F.coalesce(died_inside, F.lit(False)).alias("in_icu_mortality"),
            recode(place, layout.locations).alias("hos_discharge_location"),
            *(["first_unit", "last_unit"] if layout.units else []),
        )
    )


def _offset_stays(stays: DataFrame, layout: StayLayout) -> DataFrame:
    """Layout whose times are minutes from the start of the stay; the start itself is the constant 0."""
    cap_text, cap_value = layout.age_cap
    age = F.when(F.col(layout.age) == cap_text, F.lit(cap_value)).otherwise(F.col(layout.age).try_cast("int"))
    status, expired = layout.unit_status
    out = F.col(layout.outtime).try_cast("long")
    return stays.where(F.col(layout.age).isNotNull()).select(
        _as_long(stays, layout.stay).alias("stay_id"),
        _as_long(stays, layout.admission).alias("hadm_id"),
        F.col(layout.patient).cast("string").alias("patient_id"),
        (out / 60 / 24).alias("los"),
        age.cast("int").alias("age"),
        F.timestamp_seconds(F.lit(0)).alias("intime"),
        out.alias("outtime_min"),
        F.col(layout.dischtime).try_cast("long").alias("dischtime_min"),
        F.coalesce(F.col(status) == expired, F.lit(False)).alias("in_icu_mortality"),
        recode(F.col(layout.location), layout.locations).alias("hos_discharge_location"),
        *([F.col(layout.visit_order).try_cast("long").alias("visit_order")] if layout.visit_order else []),
    )


def select_cohort(
    stays: DataFrame,
    obs: int,
    gap: int = 0,
    min_age: int = 0,
    max_age: int | None = None,
    single_unit: tuple[str, str] | None = None,
) -> DataFrame:
    """Stays long enough for the observation window and gap, in the age range, and (if asked) in one unit."""
    keep = (F.col("los") >= (obs + gap) / 24) & (F.col("age") >= min_age)
    if max_age is not None:
        keep = keep & (F.col("age") <= max_age)
    if single_unit:
        first, last = single_unit
        keep = keep & (F.col(first) == F.col(last))
    return stays.where(keep)


def _one_per_admission(stays: DataFrame, keys: Keys, order: Column) -> DataFrame:
    """First row per admission. Filtering the row number keeps one row per admission and task before the
    shuffle (window group limit), so an admission holding most stays costs no more than any other."""
    window = Window.partitionBy(keys.admission).orderBy(order, F.col(keys.stay).asc())
    return (
        stays.where(F.col(keys.admission).isNotNull())
        .withColumn("_nth", F.row_number().over(window))
        .where("_nth = 1")
        .drop("_nth")
    )


def label_readmission(cohort: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """0 for the last stay of each admission (ties: smallest stay), 1 for the others.

    The winners are joined back on the unique stay key, not on the admission, so the join cannot skew.
    """
    slim = cohort.select(keys.admission, keys.stay, keys.order_by)
    last = _one_per_admission(slim, keys, F.col(keys.order_by).desc_nulls_last())
    flagged = last.select(keys.stay, F.lit(0).alias("readmission"))
    return cohort.join(flagged, keys.stay, "left").withColumn("readmission", F.coalesce("readmission", F.lit(1)))


def first_stay(cohort: DataFrame, keys: Keys = Keys()) -> DataFrame:
    return _one_per_admission(cohort, keys, F.col(keys.order_by).asc_nulls_last())
