"""eICU described as data."""

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

# Discharge locations, laboratory names and column lists of the data set.
LOCATIONS = {
    "Home": "Home",
    "IN_ICU_MORTALITY": "IN_ICU_MORTALITY",
    "Nursing Home": "Other",
    "Other": "Other",
    "Other External": "Other",
    "Other Hospital": "Other",
    "Rehabilitation": "Rehabilitation",
    "Skilled Nursing Facility": "Skilled Nursing Facility",
    "Death": "Death",
}

SPEC = SourceSpec(
    name="eicu",
    stays="patient",
    layout=StayLayout(
        mode="capped",
        stay="patientunitstayid",
        admission="patienthealthsystemstayid",
        patient="uniquepid",
        age="age",
        age_cap=("> 89", 300),
        outtime="unitdischargeoffset",
        dischtime="hospitaldischargeoffset",
        location="hospitaldischargelocation",
        locations=LOCATIONS,
        unit_status=("unitdischargestatus", "Expired"),
        visit_order="unitvisitnumber",
    ),
    events=(
        EventTableSpec("lab", "labresultoffset", "min", ("labid", "labresultrevisedoffset"), {}, ("labid",)),
        EventTableSpec(
            "medication",
            "drugstartoffset",
            "min",
            ("drugorderoffset", "drugstopoffset", "medicationid", "gtc", "drughiclseqno", "drugordercancelled"),
            {},
            ("medicationid",),
        ),
        EventTableSpec("infusionDrug", "infusionoffset", "min", ("infusiondrugid",), {}, ("infusiondrugid",)),
    ),
    diagnosis=DiagnosisSpec(
        "diagnosis", "paths", code="icd9code", path="diagnosisstring", missing="empty", key="patientunitstayid"
    ),
    labs=LabTable(
        "lab",
        code="labname",
        value="labresult",
        time="labresultoffset",
        unit="min",
        key="stay",
        tasks=(
            MeasurementTask("bilirubin", ("total bilirubin",), Bins((1.2, 2.0, 6.0, 12.0))),
            MeasurementTask("platelets", ("platelets x 1000",), Bins((150.0, 100.0, 50.0, 20.0), descending=True)),
            MeasurementTask("creatinine", ("creatinine",), Bins((1.2, 2.0, 3.5, 5.0)), before_exclusion=True),
            MeasurementTask("wbc", ("WBC x 1000",), Band(4.0, 12.0)),
        ),
    ),
    exclusion=ExclusionSpec(
        key="stay",
        unit="min",
        drop_multi_stay=True,
        rules=(ExclusionRule("intakeOutput", "try_cast(dialysistotal as double) <> 0", "intakeoutputoffset"),),
    ),
)
