"""Bounds, nulls and ties on literal rows."""

from datetime import datetime

import pytest

from wardloom.operators import attach, cohort, exclusions, measurements, outcomes
from wardloom.spec import Band, Bins, ExclusionRule, Keys, LabTable, MeasurementTask, Params, StayLayout

SCHEMA = (
    "stay_id long, hadm_id long, patient_id long, los double, age int, intime timestamp, outtime_min long, dischtime_min long, "
    "in_icu_mortality boolean, hos_discharge_location string"
)
START = datetime(2020, 1, 1)


def stay(stay_id, hadm_id=1, patient_id=1, los=2.0, age=50, intime=START, out=3000, disch=4000, dead=False, place="Home"):
    return (stay_id, hadm_id, patient_id, los, age, intime, out, disch, dead, place)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def column(df, name):
    return {r.stay_id: r[name] for r in df.collect()}


def test_birthdate_layout(spark):
    layout = StayLayout(
        mode="birthdate", stay="S", admission="H", patient="P", intime="IN", outtime="OUT", los="LOS", units=("F", "L"),
        birth_date="DOB", dischtime="D", location="W", died="DEAD/EXPIRED", locations={"Death": "Death", "SNF": "Skilled"},
    )
    stays = spark.createDataFrame(
        [
            ("1", "10", "100", "2020-03-01 10:00:00", "2020-03-02 10:00:30", "1.0", "A", "A"),
            ("2", "10", "100", "2020-02-28 10:00:00", None, "x", "A", "B"),
            ("3", "11", "101", "2020-03-01 10:00:00", "2020-03-02 10:00:00", "1.5", "A", "A"),
        ],
        "S string, H string, P string, IN string, OUT string, LOS string, F string, L string",
    )
    patients = spark.createDataFrame([("100", "1960-02-29 00:00:00")], "P string, DOB string")
    admissions = spark.createDataFrame(
        [("10", "2020-03-01 09:59:59", "SNF"), ("11", "2020-03-02 10:00:00", "DEAD/EXPIRED")], "H string, D string, W string"
    )
    rows = {r.stay_id: r for r in cohort.normalize_stays(stays, layout, patients, admissions).collect()}
    assert (rows[1].age, rows[2].age, rows[3].age) == (60, 59, None)  # day after, day before the birthday, unknown patient
    assert (rows[1].outtime_min, rows[1].dischtime_min) == (1440, -1)  # floor, also below zero
    assert rows[2].outtime_min is None and rows[2].los is None
    assert (rows[1].in_icu_mortality, rows[3].in_icu_mortality) == (False, True)
    assert (rows[1].hos_discharge_location, rows[3].hos_discharge_location) == ("Skilled", "Death")


def test_capped_layout(spark):
    layout = StayLayout(
        mode="capped", stay="s", admission="h", patient="p", age="age", age_cap=("> 89", 300), outtime="o", dischtime="d",
        location="w", locations={"Home": "Home"}, unit_status=("st", "Expired"), visit_order="v",
    )
    stays = spark.createDataFrame(
        [
            ("1", "10", "a-1", "> 89", "1440", "2000", "Home", "Expired", "1"),
            ("2", "10", "a-1", None, "1440", "2000", "Home", "Alive", "2"),
            ("3", "10", "a-1", "45", "720", None, "Elsewhere", None, "3"),
        ],
        "s string, h string, p string, age string, o string, d string, w string, st string, v string",
    )
    rows = {r.stay_id: r for r in cohort.normalize_stays(stays, layout).collect()}
    assert set(rows) == {1, 3}
    assert (rows[1].age, rows[3].age) == (300, 45)
    assert (rows[1].los, rows[3].los) == (1.0, 0.5)
    assert (rows[1].in_icu_mortality, rows[3].in_icu_mortality) == (True, False)
    assert rows[3].hos_discharge_location is None and rows[3].dischtime_min is None


def test_select_cohort_bounds(spark):
    stays = frame(spark, [stay(1, los=0.5), stay(2, los=0.49), stay(3, age=17), stay(4, age=18), stay(5, age=61), stay(6, age=None)])
    assert set(column(cohort.select_cohort(stays, 12, 0, 18, 60), "age")) == {1, 4}


def test_readmission_and_first_stay_with_ties(spark):
    later = datetime(2020, 1, 5)
    rows = [stay(1), stay(2, intime=later), stay(3, intime=later), stay(4, hadm_id=2), stay(5, hadm_id=None)]
    stays = frame(spark, rows)
    assert column(cohort.label_readmission(stays), "readmission") == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}
    tied = frame(spark, [stay(8), stay(7), stay(9, intime=later)])
    assert list(column(cohort.first_stay(tied), "age")) == [7]


def test_death_bounds(spark):
    lower, upper = 12 * 60, 36 * 60
    rows = [stay(i, disch=m, place="Death") for i, m in enumerate([lower, lower + 1, upper, upper + 1, None])]
    rows += [stay(8, disch=lower + 1, place=None, dead=True), stay(9, disch=lower + 1)]
    stays = frame(spark, rows)
    assert column(outcomes.label_death_within(stays, 12, 0, 24), "mortality") == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0, 8: 0, 9: 0}
    with_unit = outcomes.label_death_within(stays, 12, 0, 24, include_unit_death=True)
    assert column(with_unit, "mortality")[8] == 1


def test_imminent_discharge_bounds_and_classes(spark):
    lower, upper = 12 * 60, 36 * 60
    rows = [stay(1, disch=lower), stay(2, disch=upper), stay(3, disch=upper + 1), stay(4, disch=None), stay(5, disch=lower, place=None)]
    rows += [stay(6, disch=lower, dead=True, place=None), stay(7, disch=lower, place="Death")]
    coded, dictionary = outcomes.label_imminent_discharge(frame(spark, rows), 12, 0, 24)
    names = {r["index"]: r["name"] for r in dictionary.collect()}
    assert names == {0: "Death", 1: "Home", 2: "No Discharge"}
    assert column(coded, "imminent_discharge") == {1: 1, 2: 1, 3: 2, 4: 2, 5: -1, 6: 0, 7: 0}


def test_final_acuity_overrides(spark):
    rows = [stay(1, place="Death"), stay(2, place="Death", dead=True), stay(3), stay(4, place=None)]
    text = column(outcomes.final_acuity(frame(spark, rows)), "final_acuity")
    assert text == {1: "IN_HOSPITAL_MORTALITY", 2: "IN_ICU_MORTALITY", 3: "Home", 4: None}


def test_los_is_strict(spark):
    stays = frame(spark, [stay(1, los=3.0), stay(2, los=3.001), stay(3, los=None)])
    assert column(outcomes.label_los(stays, 3), "los_3day") == {1: 0, 2: 1, 3: 0}


@pytest.mark.parametrize(
    "rule, value, expected",
    [
        (Bins((1.2, 2.0)), 1.19, 0),
        (Bins((1.2, 2.0)), 1.2, 1),
        (Bins((1.2, 2.0)), 2.0, 2),
        (Bins((150.0, 100.0), descending=True), 150.0, 0),
        (Bins((150.0, 100.0), descending=True), 149.9, 1),
        (Bins((150.0, 100.0), descending=True), 99.0, 2),
        (Band(4.0, 12.0), 3.9, 0),
        (Band(4.0, 12.0), 4.0, 1),
        (Band(4.0, 12.0), 12.0, 1),
        (Band(4.0, 12.0), 12.1, 2),
    ],
)
def test_bins(spark, rule, value, expected):
    from pyspark.sql import functions as F

    assert spark.range(1).select(measurements.binned(F.lit(value), rule)).first()[0] == expected


def test_measurement_window_and_values(spark):
    """Window 12..36 h, both ends included after rounding to minutes; unreadable values do not count."""
    lab = LabTable("l", "item", "value", "at", "abs", "admission")
    task = MeasurementTask("m", (7,), Bins((10.0,)), before_exclusion=True)
    rows = [
        ("1", "7", "2020-01-01 11:59:29", "100"),  # rounds to minute 719
        ("1", "7", "2020-01-01 11:59:30", "4"),  # half a minute rounds up to 720
        ("1", "7", "2020-01-02 12:00:29", "6"),
        ("1", "7", "2020-01-02 12:00:30", "100"),
        ("1", "7", "2020-01-01 20:00:00", "text"),
        ("1", "7", "2020-01-01 20:00:00", None),
        ("1", "8", "2020-01-01 20:00:00", "100"),
        ("1", "7", "not a time", "100"),
        ("2", "7", "2020-01-01 20:00:00", "0.5"),
        ("3", "7", "2020-01-01 20:00:00", "50"),
    ]
    labs = spark.createDataFrame(rows, "hadm_id string, item string, at string, value string").selectExpr(
        "cast(hadm_id as long) hadm_id", "item", "at", "value"
    )
    stays = frame(spark, [stay(1), stay(2, hadm_id=2, patient_id=2), stay(3, hadm_id=3, patient_id=3), stay(4, hadm_id=4)])
    out = measurements.label_measurement(stays, labs, lab, [task], 12, 0, 24)
    assert column(out, "m") == {1: 0, 2: 0, 3: 1, 4: None}
    excluded = spark.createDataFrame([(3, datetime(2020, 1, 1, 20))], "patient_id long, first_excl timestamp")
    out = measurements.label_measurement(stays, labs, lab, [task], 12, 0, 24, Keys(), excluded, "patient_id")
    assert column(out, "m") == {1: 0, 2: 0, 3: None, 4: None}  # an exclusion at the same moment already counts


def test_measurement_by_offsets(spark):
    lab = LabTable("l", "item", "value", "off", "min", "stay")
    task = MeasurementTask("m", ("x",), Bins((10.0,)), before_exclusion=True)
    rows = [(1, "x", "720", "4"), (1, "x", "2160", "30"), (1, "x", "2161", "900"), (2, "x", "719", "50"), (3, "x", "900", "50")]
    labs = spark.createDataFrame(rows, "stay_id long, item string, off string, value string")
    stays = frame(spark, [stay(1), stay(2), stay(3)])
    excluded = spark.createDataFrame([(3, 899)], "stay_id long, first_excl int")
    out = measurements.label_measurement(stays, labs, lab, [task], 12, 0, 24, Keys(), excluded, "stay_id")
    assert column(out, "m") == {1: 1, 2: None, 3: None}


def test_first_exclusion_numbers_are_numbers(spark):
    table = spark.createDataFrame(
        [("1", "5", "0.5", "90"), ("1", "5", "1", "100"), ("2", "5", "0", "10"), ("3", "6", "9", "10"), ("4", "5", "n/a", "10")],
        "stay_id string, item string, amount string, off string",
    )
    rule = ExclusionRule("t", "try_cast(item as int) in (5) and try_cast(amount as double) > 0", "off")
    out = exclusions.first_exclusion({"t": table}, [rule], "stay_id", "min")
    assert {r.stay_id: r.first_excl for r in out.collect()} == {"1": 90}  # as text, 100 would come before 90


def test_multi_stay_exclusion(spark):
    stays = frame(spark, [stay(1), stay(2), stay(3, patient_id=2, hadm_id=2), stay(4, patient_id=3), stay(5, patient_id=3)])
    touched = spark.createDataFrame([(1, 5), (3, 5)], "stay_id long, first_excl int")
    kept = exclusions.drop_multi_stay_excluded(stays, stays, touched)
    assert set(column(kept, "age")) == {3, 4, 5}  # patient 1 goes, patient 2 has one stay, patient 3 has no exclusion
    assert set(column(exclusions.drop_multi_stay_excluded(stays, stays, touched, distinct=True), "age")) == {1, 2, 3, 4, 5}


def events(spark, rows, key):
    return spark.createDataFrame(rows, f"event_id int, {key} long, at timestamp")


def test_observation_bounds(spark):
    """From half a minute before the start (excluded) to the last minute (included)."""
    moments = [datetime(2019, 12, 31, 23, 59, 29), datetime(2019, 12, 31, 23, 59, 30), datetime(2019, 12, 31, 23, 59, 31), START]
    moments += [datetime(2020, 1, 1, 12, 0, 29), datetime(2020, 1, 1, 12, 0, 30)]
    rows = events(spark, [(i, 1, m) for i, m in enumerate(moments)], "stay_id")
    stays = frame(spark, [stay(1, out=None)])
    for attached in (attach.attach_by_stay(rows, stays), attach.attach_observed(rows, stays, "at", 12)):
        seen = attach.observation_window(attached, 12, "abs", "at")
        assert sorted((r.event_id, r.time_min) for r in seen.collect()) == [(2, 0), (3, 0), (4, 720)]
        assert "at" not in seen.columns


def test_attach_by_admission_fans_out_to_the_stays_in_range(spark):
    stays = frame(
        spark,
        [stay(1, out=60), stay(2, intime=datetime(2020, 1, 1, 0, 30), out=6000), stay(3, out=None), stay(4, hadm_id=2, out=60)],
    )
    rows = events(spark, [(1, 1, datetime(2020, 1, 1, 0, 45)), (2, 1, datetime(2020, 1, 1, 2)), (3, 1, None), (4, 9, START)], "hadm_id")
    for width in (60, 3600, attach.DAY):
        out = attach.attach_by_admission(rows, stays, "at", slice_seconds=width)
        assert sorted((r.event_id, r.stay_id) for r in out.collect()) == [(1, 1), (1, 2), (2, 2)]


def test_offset_tables_keep_their_time_column(spark):
    rows = spark.createDataFrame([(1, "0", "a"), (1, "720", "b"), (1, "721", "c"), (1, "-1", "d"), (1, None, "e")], "stay_id long, off string, v string")
    seen = attach.observation_window(rows, 12, "min", "off")
    assert sorted((r.v, r.off, r.time_min) for r in seen.collect()) == [("a", "0", 0), ("b", "720", 720)]


def test_describe_codes_unknown_and_null(spark):
    rows = spark.createDataFrame([(1, "5"), (2, "6"), (3, None), (4, "7")], "i int, item string")
    names = spark.createDataFrame([("5", "five"), ("7", None)], "code string, text string")
    out = attach.describe_codes(rows, {"item": names})
    assert out.columns == ["i", "item"]
    assert {r.i: r.item for r in out.collect()} == {1: "five", 2: None, 3: None, 4: None}


@pytest.mark.parametrize("wrong", [{"min_events": 0}, {"min_events": 9, "max_events": 8}, {"min_age": 5, "max_age": 4}, {"valid_percent": 0.6}])
def test_params_are_checked(wrong):
    with pytest.raises(ValueError):
        Params(**wrong)
