"""MIMIC-IV described as data."""

from wardloom.sources.rules import any_of, items, positive
from wardloom.spec import (
    Band,
    Bins,
    DiagnosisSpec,
    EventTableSpec,
    ExclusionRule,
    ExclusionSpec,
    LabTable,
    MeasurementTask,
    SourceSpec,
    StayLayout,
)

# Discharge locations, item ids and column lists of the data set.
LOCATIONS = {
    "ACUTE HOSPITAL": "Other",
    "AGAINST ADVICE": "Other",
    "ASSISTED LIVING": "Other",
    "CHRONIC/LONG TERM ACUTE CARE": "Other",
    "HEALTHCARE FACILITY": "Other",
    "HOME": "Home",
    "HOME HEALTH CARE": "Home",
    "HOSPICE": "Other",
    "IN_ICU_MORTALITY": "IN_ICU_MORTALITY",
    "OTHER FACILITY": "Other",
    "PSYCH FACILITY": "Other",
    "REHAB": "Rehabilitation",
    "SKILLED NURSING FACILITY": "Skilled Nursing Facility",
    "Death": "Death",
}

CREATININE, BILIRUBIN, PLATELETS, WHITE_CELLS = (50912,), (50885,), (51265,), (51300, 51301, 51755)
CHARTED = (
    226499, 224154, 225183, 227438, 224191, 225806, 225807, 228004, 228005, 228006, 224144, 224145, 224153, 226457,
)
INPUT = (227536, 227525)
PROCEDURE = (225441, 225802, 225803, 225805, 225809, 225955)
CHARTED_IN_USE = "try_cast(itemid as int) = 225965 and value = 'In use'"

SPEC = SourceSpec(
    name="mimiciv",
    stays="icu/icustays",
    patients="hosp/patients",
    admissions="hosp/admissions",
    layout=StayLayout(
        mode="anchor",
        stay="stay_id",
        admission="hadm_id",
        patient="subject_id",
        intime="intime",
        outtime="outtime",
        los="los",
        units=("first_careunit", "last_careunit"),
        anchor_year="anchor_year",
        anchor_age="anchor_age",
        dischtime="dischtime",
        location="discharge_location",
        died="DIED",
        locations=LOCATIONS,
    ),
    events=(
        EventTableSpec(
            "hosp/labevents",
            "charttime",
            "abs",
            ("labevent_id", "storetime", "subject_id", "specimen_id", "order_provider_id"),
            {"itemid": ("hosp/d_labitems", "label")},
            ("labevent_id",),
        ),
        EventTableSpec(
            "hosp/prescriptions",
            "starttime",
            "abs",
            (
                "gsn",
                "ndc",
                "subject_id",
                "pharmacy_id",
                "poe_id",
                "poe_seq",
                "formulary_drug_cd",
                "stoptime",
                "order_provider_id",
            ),
        ),
        EventTableSpec(
            "icu/inputevents",
            "starttime",
            "abs",
            ("endtime", "storetime", "orderid", "linkorderid", "subject_id", "continueinnextdept", "statusdescription"),
            {"itemid": ("icu/d_items", "label")},
        ),
    ),
    diagnosis=DiagnosisSpec(
        "hosp/diagnoses_icd", "versioned", code="icd_code", version="icd_version", missing="drop", key="hadm_id"
    ),
    labs=LabTable(
        "hosp/labevents",
        code="itemid",
        value="valuenum",
        time="charttime",
        unit="abs",
        key="admission",
        tasks=(
            MeasurementTask("bilirubin", BILIRUBIN, Bins((1.2, 2.0, 6.0, 12.0))),
            MeasurementTask("platelets", PLATELETS, Bins((150.0, 100.0, 50.0, 20.0), descending=True)),
            MeasurementTask("creatinine", CREATININE, Bins((1.2, 2.0, 3.5, 5.0)), before_exclusion=True),
            MeasurementTask("wbc", WHITE_CELLS, Band(4.0, 12.0)),
        ),
    ),
    exclusion=ExclusionSpec(
        key="patient",
        rules=(
            ExclusionRule(
                "icu/chartevents", any_of(CHARTED_IN_USE, items("itemid", CHARTED) + " and value is not null"), "charttime"
            ),
            ExclusionRule("icu/inputevents", f"{items('itemid', INPUT)} and {positive('amount')}", "starttime"),
            ExclusionRule("icu/procedureevents", items("itemid", PROCEDURE) + " and value is not null", "starttime"),
        ),
    ),
)
