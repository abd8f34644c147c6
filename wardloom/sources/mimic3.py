"""MIMIC-III described as data."""

from wardloom.sources.rules import any_of, carried, items, positive
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
    "DISC-TRAN CANCER/CHLDRN H": "Other",
    "DISC-TRAN TO FEDERAL HC": "Other",
    "DISCH-TRAN TO PSYCH HOSP": "Other",
    "HOME": "Home",
    "HOME HEALTH CARE": "Home",
    "HOME WITH HOME IV PROVIDR": "Home",
    "HOSPICE-HOME": "Other",
    "HOSPICE-MEDICAL FACILITY": "Other",
    "ICF": "Other",
    "IN_ICU_MORTALITY": "IN_ICU_MORTALITY",
    "LEFT AGAINST MEDICAL ADVI": "Other",
    "LONG TERM CARE HOSPITAL": "Other",
    "OTHER FACILITY": "Other",
    "REHAB/DISTINCT PART HOSP": "Rehabilitation",
    "SHORT TERM HOSPITAL": "Other",
    "SNF": "Skilled Nursing Facility",
    "SNF-MEDICAID ONLY CERTIF": "Skilled Nursing Facility",
    "Death": "Death",
}

CREATININE, BILIRUBIN, PLATELETS, WHITE_CELLS = (50912,), (50885,), (51265,), (51300, 51301)

# charted items that count with any value, and those that count with the listed values only
CHARTED_ANY = (152, 148, 149, 146, 147, 151, 150)
CHARTED_VALUES = (
    ((229, 235, 241, 247, 253, 259, 265, 271), ("Dialysis Line",)),
    ((466,), ("Dialysis RN",)),
    ((927,), ("Dialysis Solutions",)),
    ((6250,), ("dialys",)),
    (
        (917,),
        (
            "+ INITIATE DIALYSIS",
            "BLEEDING FROM DIALYSIS CATHETER",
            "FAILED DIALYSIS CATH.",
            "FEBRILE SYNDROME;DIALYSIS",
            "HYPOTENSION WITH HEMODIALYSIS",
            "HYPOTENSION.GLOGGED DIALYSIS",
            "INFECTED DIALYSIS CATHETER",
        ),
    ),
    ((582,), ("CAVH Start", "CAVH D/C", "CVVHD Start", "CVVHD D/C", "Hemodialysis st", "Hemodialysis end")),
)
CHARTED_POSITIVE = (
    226118, 227357, 225725, 226499, 224154, 225810, 227639, 225183, 227438, 224191, 225806, 225807, 228004, 228005,
    228006, 224144, 224145, 224149, 224150, 224151, 224152, 224153, 224404, 224406, 226457, 225959, 224135, 224139,
    224146, 225323, 225740, 225776, 225951, 225952, 225953, 225954, 225956, 225958, 225961, 225963, 225965, 225976,
    225977, 227124, 227290, 227638, 227640, 227753,
)
INPUT_CV = (
    40788, 40907, 41063, 41147, 41307, 41460, 41620, 41711, 41791, 41792, 42562, 43829, 44037, 44188, 44526, 44527,
    44584, 44591, 44698, 44927, 44954, 45157, 45268, 45352, 45353, 46012, 46013, 46172, 46173, 46250, 46262, 46292,
    46293, 46311, 46389, 46574, 46681, 46720, 46769, 46773,
)
OUTPUT = (
    40386, 40425, 40426, 40507, 40613, 40624, 40690, 40745, 40789, 40881, 40910, 41016, 41034, 41069, 41112, 41250,
    41374, 41417, 41500, 41527, 41623, 41635, 41713, 41750, 41829, 41842, 41897, 42289, 42388, 42464, 42524, 42536,
    42868, 42928, 42972, 43016, 43052, 43098, 43115, 43687, 43941, 44027, 44085, 44193, 44199, 44216, 44286, 44567,
    44843, 44845, 44857, 44901, 44943, 45479, 45828, 46230, 46232, 46394, 46464, 46712, 46713, 46715, 46741,
)
INPUT_MV = (227536, 227525)
DATETIME = (225318, 225319, 225321, 225322, 225324)
PROCEDURE = (225441, 225802, 225803, 225805, 224270, 225809, 225955, 225436)

NO_ERROR = "(ERROR is null or try_cast(ERROR as int) = 0)"
CHARTED_CAREVUE = any_of(
    items("ITEMID", CHARTED_ANY) + " and VALUE is not null",
    *[f"{items('ITEMID', ids)} and {carried('VALUE', values)}" for ids, values in CHARTED_VALUES],
)

SPEC = SourceSpec(
    name="mimiciii",
    stays="ICUSTAYS",
    patients="PATIENTS",
    admissions="ADMISSIONS",
    layout=StayLayout(
        mode="birthdate",
        stay="ICUSTAY_ID",
        admission="HADM_ID",
        patient="SUBJECT_ID",
        intime="INTIME",
        outtime="OUTTIME",
        los="LOS",
        units=("FIRST_CAREUNIT", "LAST_CAREUNIT"),
        birth_date="DOB",
        dischtime="DISCHTIME",
        location="DISCHARGE_LOCATION",
        died="DEAD/EXPIRED",
        locations=LOCATIONS,
    ),
    events=(
        EventTableSpec(
            "LABEVENTS", "CHARTTIME", "abs", ("ROW_ID", "SUBJECT_ID"), {"ITEMID": ("D_LABITEMS", "LABEL")}, ("ROW_ID",)
        ),
        EventTableSpec(
            "PRESCRIPTIONS", "STARTDATE", "abs", ("ENDDATE", "GSN", "NDC", "ROW_ID", "SUBJECT_ID"), {}, ("ROW_ID",)
        ),
        EventTableSpec(
            "INPUTEVENTS_MV",
            "STARTTIME",
            "abs",
            (
                "ENDTIME",
                "STORETIME",
                "CGID",
                "ORDERID",
                "LINKORDERID",
                "ROW_ID",
                "SUBJECT_ID",
                "CONTINUEINNEXTDEPT",
                "CANCELREASON",
                "STATUSDESCRIPTION",
                "COMMENTS_CANCELEDBY",
                "COMMENTS_DATE",
            ),
            {"ITEMID": ("D_ITEMS", "LABEL")},
            ("ROW_ID",),
        ),
        EventTableSpec(
            "INPUTEVENTS_CV",
            "CHARTTIME",
            "abs",
            ("STORETIME", "CGID", "ORDERID", "LINKORDERID", "ROW_ID", "STOPPED", "SUBJECT_ID"),
            {"ITEMID": ("D_ITEMS", "LABEL")},
            ("ROW_ID",),
        ),
    ),
    diagnosis=DiagnosisSpec("DIAGNOSES_ICD", "versioned", code="ICD9_CODE", missing="drop", key="HADM_ID"),
    labs=LabTable(
        "LABEVENTS",
        code="ITEMID",
        value="VALUENUM",
        time="CHARTTIME",
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
                "CHARTEVENTS",
                f"{NO_ERROR} and {CHARTED_CAREVUE}",
                "CHARTTIME",
                only_stays=("ICUSTAYS", "DBSOURCE = 'carevue'"),
            ),
            ExclusionRule(
                "CHARTEVENTS", f"{NO_ERROR} and {items('ITEMID', CHARTED_POSITIVE)} and {positive('VALUENUM')}", "CHARTTIME"
            ),
            ExclusionRule("INPUTEVENTS_CV", f"{items('ITEMID', INPUT_CV)} and {positive('AMOUNT')}", "CHARTTIME"),
            ExclusionRule("OUTPUTEVENTS", f"{items('ITEMID', OUTPUT)} and {positive('VALUE')}", "CHARTTIME"),
            ExclusionRule("INPUTEVENTS_MV", f"{items('ITEMID', INPUT_MV)} and {positive('AMOUNT')}", "STARTTIME"),
            ExclusionRule("DATETIMEEVENTS", items("ITEMID", DATETIME), "CHARTTIME"),
            ExclusionRule("PROCEDUREEVENTS_MV", items("ITEMID", PROCEDURE), "STARTTIME"),
        ),
    ),
)
