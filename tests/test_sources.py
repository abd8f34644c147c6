"""The three source descriptions, from files to packed stays."""

import csv
import gzip
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardloom.plans.run import open_source, run
from wardloom.sources import eicu, mimic3, mimic4, tables
from wardloom.spec import Params

LABELS = Params().labels
WORDS = ["lab", "##events", "itemid", "valuenum", "creatinine", "sodium", "high", "lab", "drug", "aspirin", "labname", "labresult",
         "labresultoffset", "medication", "drugname", "drugstartoffset", "flag", "value", "##uom", "input", "amount", "##e", "##v", "mg"]
VOCAB = {w: 300 + i for i, w in enumerate(dict.fromkeys(WORDS))}


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame(list(VOCAB.items()), "token string, id int")


def write(root: Path, name: str, header: str, rows, suffix=".csv"):
    path = root / (name + suffix)
    path.parent.mkdir(parents=True, exist_ok=True)
    opener = gzip.open if suffix.endswith(".gz") else open
    with opener(path, "wt", newline="") as f:
        out = csv.writer(f)
        out.writerow(header.split(","))
        out.writerows(rows)


CCS = [("'0010 '", "'1'"), ("'4019 '", "'7'"), ("'V01  '", "'15'"), ("'E999 '", "'18'"), ("'5849 '", "'10'")]
GEM = [("A000", "0010", "x"), ("I10", "0010", "x"), ("I10", "4019", "x"), ("N179", "5849", "x")]
T0 = datetime(2150, 1, 1, 8)


def at(hours=0.0, minutes=0):
    return (T0 + timedelta(hours=hours, minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S")


def code_systems(spark, root):
    write(root, "ccs", "'ICD-9-CM CODE','CCS LVL 1'", CCS)
    write(root, "gem", "icd10cm,icd9cm,flags", GEM)
    return tables.read_categories(spark, f"{root}/ccs.csv"), tables.read_crosswalk(spark, f"{root}/gem.csv")


def test_code_systems(spark, tmp_path):
    categories, crosswalk = code_systems(spark, tmp_path)
    assert {r.code: r.category for r in categories.collect()} == {"0010": 0, "4019": 6, "V01": 14, "E999": 17, "5849": 9}
    assert [(r.source, r.target) for r in crosswalk.orderBy("ord").collect()] == [(a, b) for a, b, _ in GEM]


@pytest.mark.parametrize("suffix", [".csv", ".csv.gz"])
def test_scans_by_name_and_type(spark, tmp_path, suffix):
    write(tmp_path, "t", "code,n,at", [("007", "5", "2020-01-01 00:00:00"), ("008", "x", "never"), ('a "b", c', "", "")], suffix)
    df = tables.read_table(spark, str(tmp_path), "t", "n int, at timestamp")
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "int", "timestamp"]
    assert sorted((r.code, r.n) for r in df.collect()) == [("007", 5), ("008", None), ('a "b", c', None)]
    df.write.parquet(str(tmp_path / "p.parquet"))
    assert tables.read_table(spark, str(tmp_path), "p").count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path), "missing")


def test_the_last_text_of_a_code_counts(spark, tmp_path):
    write(tmp_path, "d", "itemid,label", [("1", "a"), ("2", "b"), ("1", "c"), ("3", "")])
    got = tables.read_dictionary(spark, str(tmp_path), "d", "itemid", "label").collect()
    assert {r.code: r.text for r in got} == {"1": "c", "2": "b", "3": None}


PARAMS = dict(obs=12, pred=24, min_events=2, max_events=4, max_event_tokens=24, max_stay_tokens=64, diagnosis=True, seeds=(42,), label_sources=True)


def mimic4_files(root):
    stays = [  # stay 3 changes unit, stay 4 is too short, stay 5 has too few events, stay 6 no diagnosis
        (100, 10, 1, "MICU", "MICU", at(), at(60), 2.5),
        (100, 10, 2, "MICU", "MICU", at(61), at(100), 1.6),
        (101, 11, 3, "MICU", "SICU", at(), at(60), 2.5),
        (101, 11, 4, "MICU", "MICU", at(70), at(75), 0.2),
        (102, 12, 5, "MICU", "MICU", at(), at(30), 1.25),
        (103, 13, 6, "MICU", "MICU", at(), at(30), 1.25),
    ]
    write(root, "icu/icustays", "subject_id,hadm_id,stay_id,first_careunit,last_careunit,intime,outtime,los", stays, ".csv.gz")
    write(root, "hosp/patients", "subject_id,anchor_year,anchor_age", [(s, 2148, 60) for s in (100, 101, 102, 103)], ".csv.gz")
    admissions = [(10, at(110), "DIED", ""), (11, at(80), "HOME", ""), (12, at(30), "DIED", ""), (13, at(31), "HOME", "")]
    write(root, "hosp/admissions", "hadm_id,dischtime,discharge_location,deathtime", admissions, ".csv.gz")
    dx = [(10, "0010", 9), (10, "I10", 10), (10, "V01", 9), (10, "E999", 9), (11, "0010", 9), (12, "N179", 10), (13, "ZZZ", 10)]
    write(root, "hosp/diagnoses_icd", "hadm_id,icd_code,icd_version", dx, ".csv.gz")
    labs = [
        (1, 100, 10, 50912, at(1), "1.25", "high"),
        (2, 100, 10, 50983, at(2), "140", ""),
        (3, 100, 10, 99999, at(3), "7", ""),
        (4, 100, 10, 50983, at(13), "141", ""),  # after the observation window of stay 1
        (5, 100, 10, 50912, at(20), "3.0", ""),  # in the prediction window of stay 1
        (6, 100, 10, 50912, at(30), "9.0", ""),  # after the dialysis
        (7, 100, 10, 50983, at(62), "142", ""),  # first hour of stay 2, also inside no other stay
        (8, 102, 12, 50983, at(1), "5", ""),
        (9, 100, 10, 50983, at(1.5), "143", ""),
        (10, 100, 10, 50983, at(1.75), "144", ""),
    ]
    write(root, "hosp/labevents", "labevent_id,subject_id,hadm_id,itemid,charttime,valuenum,flag", labs, ".csv.gz")
    write(root, "hosp/d_labitems", "itemid,label", [(50912, "Creatinine"), (50983, "Sodium")], ".csv.gz")
    write(root, "hosp/prescriptions", "subject_id,hadm_id,starttime,stoptime,drug", [(100, 10, at(0.5), at(9), "aspirin")], ".csv.gz")
    inputs = [(100, 10, 1, at(4), at(5), 227525, "0.5"), (100, 10, 1, at(25), at(26), 227525, "0.5"), (100, 10, 2, at(62), at(65), 1, "0")]
    write(root, "icu/inputevents", "subject_id,hadm_id,stay_id,starttime,endtime,itemid,amount", inputs[1:], ".csv.gz")
    write(root, "icu/d_items", "itemid,label", [(227525, "mg")], ".csv.gz")
    write(root, "icu/chartevents", "subject_id,itemid,value,charttime", [(100, 225965, "Not in use", at(1))], ".csv.gz")
    write(root, "icu/procedureevents", "subject_id,itemid,value,starttime", [(100, 225441, "", at(1))], ".csv.gz")


def test_mimic4(spark, tmp_path, vocab):
    mimic4_files(tmp_path)
    params = Params(**PARAMS, measurements=("creatinine", "wbc"))
    categories, crosswalk = code_systems(spark, tmp_path)
    result = run(open_source(spark, str(tmp_path), mimic4.SPEC, params), mimic4.SPEC, params, vocab, categories, crosswalk)
    rows = {r.stay_id: r for r in result.cohort.collect()}
    # stay 2 keeps two events only, and min_events = 2 wants more
    assert set(rows) == {1}
    r = rows[1]
    assert (r.age, r.readmission, r.mortality, r.long_term_mortality, r.los_3day) == (62, 1, 0, 1, 0)
    assert r.diagnosis == [0, 6, 16]  # 14 is the rare class; I10 maps to its last target
    assert (r.creatinine, r.wbc) == (2, None)  # 3.0 only, since 9.0 follows the dialysis
    assert result.skipped.first().asDict() == {"stays": 3, "active": 1, "skipped": 2}
    names = {x["index"]: x["name"] for x in result.dictionaries["final_acuity"].collect()}
    assert names[r.final_acuity] == "IN_HOSPITAL_MORTALITY"

    packed = {p.stay_id: p for p in result.packed.collect()}
    # the four latest events of the first 12 hours: sodium 1.5 h, 1.75 h, 2 h and the unknown item at 3 h
    assert packed[1].time == [90, 105, 120, 180]
    lab, digits = VOCAB["lab"], {str(i): 121 + i for i in range(10)}
    head = [101, lab, VOCAB["##events"]]
    value = [VOCAB["valuenum"], digits["1"], digits["4"]]
    first = head + [VOCAB["itemid"], VOCAB["sodium"], *value, digits["3"], 102]
    assert packed[1].hi[0][0] == first + [0] * (24 - len(first))
    assert packed[1].hi[0][1][: len(first)] == [5, 1, 1, 2, 3, 2, 3, 3, 3, 6]
    assert packed[1].hi[0][2][: len(first)] == [0, 0, 0, 0, 0, 0, 8, 7, 6, 0]
    last = head + [VOCAB["valuenum"], digits["7"], 102]  # the item has no text, so its unit is left out
    assert packed[1].hi[3][0] == last + [0] * (24 - len(last))
    assert len(packed[1].fl[0]) == 64 and packed[1].fl[0][: len(first)] == first


def test_first_stay_and_back_off(spark, tmp_path, vocab):
    mimic4_files(tmp_path)
    write(tmp_path, "hosp/diagnoses_icd", "hadm_id,icd_code,icd_version", [(10, "N179X", 10), (12, "N179X", 10)], ".csv.gz")
    params = Params(**(PARAMS | dict(min_events=1, first_stay_only=True, code_backoff=True, labels=("mortality",))))
    categories, crosswalk = code_systems(spark, tmp_path)
    result = run(open_source(spark, str(tmp_path), mimic4.SPEC, params), mimic4.SPEC, params, vocab, categories, crosswalk)
    assert {r.stay_id: r.diagnosis for r in result.cohort.collect()} == {1: [9]}
    assert "readmission" not in result.cohort.columns and result.dictionaries == {}


def test_finished_stages_are_reused(spark, tmp_path, vocab):
    mimic4_files(tmp_path)
    params = Params(**(PARAMS | dict(diagnosis=False)))
    inputs = open_source(spark, str(tmp_path), mimic4.SPEC, params)
    first = run(inputs, mimic4.SPEC, params, vocab, reuse=str(tmp_path))
    empty = {n: df.limit(0) for n, df in inputs.items()}
    again = run(empty, mimic4.SPEC, params, vocab, reuse=str(tmp_path))
    assert sorted(map(str, again.packed.collect())) == sorted(map(str, first.packed.collect())) != []
    # other ids under the same name are another run
    shifted = vocab.withColumn("id", F.col("id") + 1000)
    other = run(inputs, mimic4.SPEC, params, shifted, reuse=str(tmp_path))
    assert sorted(map(str, other.packed.collect())) != sorted(map(str, first.packed.collect()))
    assert run(empty, mimic4.SPEC, params, shifted, reuse=str(tmp_path)).packed.count() == first.packed.count()


def test_labels_do_not_travel_with_what_they_are_made_from(spark, tmp_path, vocab):
    mimic4_files(tmp_path)
    params = Params(**(PARAMS | dict(diagnosis=False, label_sources=False)))
    result = run(open_source(spark, str(tmp_path), mimic4.SPEC, params), mimic4.SPEC, params, vocab)
    assert not {"los", "age", "dischtime_min", "in_icu_mortality", "hos_discharge_location"} & set(result.cohort.columns)
    assert {"mortality", "final_acuity", "split_42"} <= set(result.cohort.columns)


@pytest.mark.parametrize("wrong", [dict(labels=("mortal",)), dict(measurements=("iron",))])
def test_unknown_names_are_errors(spark, vocab, wrong):
    with pytest.raises(ValueError, match="unknown"):
        run({}, mimic4.SPEC, Params(**(PARAMS | wrong)), vocab)


def test_mimic3(spark, tmp_path, vocab):
    stays = [
        (1, 100, 10, 1, "carevue", "MICU", "MICU", at(), at(60), 2.5),
        (2, 101, 11, 2, "metavision", "MICU", "MICU", at(), at(60), 2.5),
        (3, 102, 12, 3, "metavision", "MICU", "MICU", at(), at(60), 2.5),
    ]
    write(tmp_path, "ICUSTAYS", "ROW_ID,SUBJECT_ID,HADM_ID,ICUSTAY_ID,DBSOURCE,FIRST_CAREUNIT,LAST_CAREUNIT,INTIME,OUTTIME,LOS", stays)
    people = [(1, 100, "2100-01-01 00:00:00"), (2, 101, "2100-01-02 00:00:00"), (3, 102, "2140-01-01 00:00:00")]
    write(tmp_path, "PATIENTS", "ROW_ID,SUBJECT_ID,DOB", people)
    write(tmp_path, "ADMISSIONS", "HADM_ID,DISCHTIME,DISCHARGE_LOCATION,DEATHTIME", [(10, at(20), "DEAD/EXPIRED", ""), (11, at(70), "SNF", "")])
    write(tmp_path, "DIAGNOSES_ICD", "HADM_ID,ICD9_CODE", [(10, "0010"), (11, "4019"), (11, "E999"), (12, "0010")])
    labs = [(i, 100 + s, 10 + s, "", 50912, at(h), "1.0", v, "mg", "") for i, (s, h, v) in enumerate(
        [(0, 1, "1.0"), (0, 2, "1.1"), (0, 14, "1.0"), (0, 18, "9.0"), (1, 1, "1.0"), (1, 2, "1.0"), (1, 14, "1.0"), (1, 18, "9.0"), (2, 1, "1")]
    )]
    labs = [(r[0], r[1], r[2], r[4], r[5], r[6], r[7], r[8], r[9]) for r in labs]
    write(tmp_path, "LABEVENTS", "ROW_ID,SUBJECT_ID,HADM_ID,ITEMID,CHARTTIME,VALUE,VALUENUM,VALUEUOM,FLAG", labs)
    write(tmp_path, "D_LABITEMS", "ROW_ID,ITEMID,LABEL", [(1, 50912, "Creatinine")])
    write(tmp_path, "D_ITEMS", "ROW_ID,ITEMID,LABEL", [(1, 40788, "mg")])
    write(tmp_path, "PRESCRIPTIONS", "ROW_ID,SUBJECT_ID,HADM_ID,ICUSTAY_ID,STARTDATE,ENDDATE,DRUG,GSN,NDC", [(1, 100, 10, 1, at(3), "", "aspirin", "", "")])
    write(tmp_path, "INPUTEVENTS_MV", "ROW_ID,SUBJECT_ID,HADM_ID,ICUSTAY_ID,STARTTIME,ENDTIME,ITEMID,AMOUNT,STORETIME", [])
    write(tmp_path, "INPUTEVENTS_CV", "ROW_ID,SUBJECT_ID,HADM_ID,ICUSTAY_ID,CHARTTIME,ITEMID,AMOUNT,STOPPED", [(1, 101, 11, 2, at(16), 40788, "0.5", "x")])
    # stay 1 is from the first system: its text item counts; the same entry of stay 2 does not, nor one marked as an error
    chart = [
        (1, 100, 582, "Hemodialysis st", "", at(17), ""),
        (1, 100, 582, "Hemodialysis end", "", at(1), "1"),
        (2, 101, 582, "Hemodialysis st", "", at(1), ""),
        (1, 100, 7949, "anything", "", at(1), "0"),
    ]
    write(tmp_path, "CHARTEVENTS", "ICUSTAY_ID,SUBJECT_ID,ITEMID,VALUE,VALUENUM,CHARTTIME,ERROR", chart)
    write(tmp_path, "OUTPUTEVENTS", "SUBJECT_ID,ITEMID,VALUE,CHARTTIME", [(100, 40386, "0", at(1))])
    write(tmp_path, "DATETIMEEVENTS", "SUBJECT_ID,ITEMID,CHARTTIME", [(100, 1, at(1))])
    write(tmp_path, "PROCEDUREEVENTS_MV", "SUBJECT_ID,ITEMID,STARTTIME", [])
    params = Params(**(PARAMS | dict(min_events=1, min_age=18)), measurements=("creatinine", "platelets"))
    categories, _ = code_systems(spark, tmp_path)
    result = run(open_source(spark, str(tmp_path), mimic3.SPEC, params), mimic3.SPEC, params, vocab, categories)
    rows = {r.stay_id: r for r in result.cohort.collect()}
    assert {s: r.age for s, r in rows.items()} == {1: 50, 2: 49}  # patient 102 is ten years old
    assert [rows[s].diagnosis for s in (1, 2)] == [[0], [6, 16]]
    assert [rows[s].creatinine for s in (1, 2)] == [0, 0]  # the 9.0 at 18 h follows each patient's first dialysis
    assert [rows[s].mortality for s in (1, 2)] == [1, 0] and [rows[s].in_icu_mortality for s in (1, 2)] == [True, False]
    packed = {p.stay_id: p for p in result.packed.collect()}
    assert packed[1].time == [60, 120, 180] and packed[2].time == [60, 120]


def test_eicu(spark, tmp_path, vocab):
    header = "patientunitstayid,patienthealthsystemstayid,uniquepid,unitvisitnumber,age,unitdischargeoffset,hospitaldischargeoffset,unitdischargestatus,hospitaldischargelocation"
    stays = [
        (1, 10, "p-1", 1, "> 89", 3000, 4000, "Alive", "Home"),
        (2, 10, "p-1", 2, "70", 3000, 900, "Expired", "Death"),
        (3, 11, "p-2", 1, "70", 3000, 4000, "Alive", "Nursing Home"),
        (4, 12, "p-3", 1, "", 3000, 4000, "Alive", "Home"),
    ]
    write(tmp_path, "patient", header, stays)
    dx = [
        (1, 1, "renal|failure|acute", "584.9, V01"),
        (2, 1, "renal|failure|other", ""),
        (3, 2, "cardio|x", "I10"),
        (4, 3, "cardio|y|z", ""),
        (5, 3, "renal|failure|acute", "001.0"),
    ]
    write(tmp_path, "diagnosis", "diagnosisid,patientunitstayid,diagnosisstring,icd9code", dx)
    labs = []
    for stay in (1, 2, 3):
        labs += [(stay * 10, stay, 60, "creatinine", "1.5", 0), (stay * 10 + 1, stay, 0, "sodium", "140", 0), (stay * 10 + 2, stay, 900, "creatinine", "6", 0)]
    write(tmp_path, "lab", "labid,patientunitstayid,labresultoffset,labname,labresult,labresultrevisedoffset", labs)
    write(tmp_path, "medication", "medicationid,patientunitstayid,drugorderoffset,drugstartoffset,drugname", [(1, 1, 0, 721, "aspirin"), (2, 3, 0, 720, "aspirin")])
    write(tmp_path, "infusionDrug", "infusiondrugid,patientunitstayid,infusionoffset,drugname", [])
    # numbers, not text: 1000 lies after 900
    io = [(1, 1, 0, 0, 0, "12.5", 1000, 0), (2, 3, 0, 0, 0, "0.0", 5, 0)]
    write(tmp_path, "intakeOutput", "intakeoutputid,patientunitstayid,intaketotal,outputtotal,nettotal,dialysistotal,intakeoutputoffset,intakeoutputentryoffset", io)
    params = Params(**(PARAMS | dict(min_events=1, max_age=400)), measurements=("creatinine",))
    categories, crosswalk = code_systems(spark, tmp_path)
    result = run(open_source(spark, str(tmp_path), eicu.SPEC, params), eicu.SPEC, params, vocab, categories, crosswalk)
    rows = {r.stay_id: r for r in result.cohort.collect()}
    assert {s: r.age for s, r in rows.items()} == {1: 300, 2: 70, 3: 70}
    assert {s: r.readmission for s, r in rows.items()} == {1: 1, 2: 0, 3: 0}
    # V01 is the last code of the acute path and the rare class; its sibling inherits that class; I10 goes through the crosswalk
    assert {s: r.diagnosis for s, r in rows.items()} == {1: [6], 2: [6], 3: []}
    # patient p-1 has two stays and a dialysis, so no stay of theirs gets a creatinine label
    assert {s: r.creatinine for s, r in rows.items()} == {1: None, 2: None, 3: 4}
    assert {s: r.mortality for s, r in rows.items()} == {1: 0, 2: 1, 3: 0}
    packed = {p.stay_id: p for p in result.packed.collect()}
    assert packed[1].time == [0, 60] and packed[3].time == [0, 60, 720]
    digits = {str(i): 121 + i for i in range(10)}
    offset = [VOCAB["labresultoffset"], digits["0"]]
    first = [101, VOCAB["lab"], *offset, VOCAB["labname"], VOCAB["sodium"], VOCAB["labresult"], digits["1"], digits["4"], digits["0"], 102]
    assert packed[1].hi[0][0][: len(first)] == first
