"""Hand-written rows through every source: cohort, labels, events, words."""

import datetime
import os

import pytest
from checks import rows
from pyspark.sql import functions as F

from stayline.plans import pipeline
from stayline.plans.pipeline import Config
from stayline.session import saved
from stayline.sources import clinical
from stayline.sources.profile import Profile, load_profile, open_source
from stayline.sources.stays import load_stays, sicdb_blocks

ALL = ("mimiciv", "eicu", "umcdb", "hirid", "ehrshot", "nwicu", "sicdb")


def write(root, file, header, *lines, encoding="utf-8"):
    path = os.path.join(root, file)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as out:
        out.write("\n".join([header, *lines]) + "\n")


def day(n, hour=0, minute=0):
    return f"2150-01-{n:02d} {hour:02d}:{minute:02d}:00"


def cohort_of(source, config):
    """The cohort as a written table, as in a full run."""
    return saved(pipeline.build_cohort(source, config), "cohort")


COLLECTED = {}


def labels_of(df, stay, *names):
    """Labels of one stay; a labelled cohort is computed once per test."""
    if id(df) not in COLLECTED:
        COLLECTED.clear()
        COLLECTED[id(df)] = (df, {r["stay_id"]: r for r in df.collect()})
    row = COLLECTED[id(df)][1][stay]
    return tuple(row[n] for n in names)


@pytest.fixture
def mimiciv(spark, tmp_path):
    root = str(tmp_path)
    write(root, "icu/icustays.csv", "stay_id,hadm_id,subject_id,intime,los,first_careunit,last_careunit",
          f"1,10,100,{day(1, 2)},6.0,MICU,MICU",
          f"2,10,100,{day(9, 0)},3.0,MICU,MICU",
          f"3,11,101,{day(1, 0)},5.0,MICU,SICU",
          f"4,12,102,{day(1, 0)},1.0,MICU,MICU",
          f"5,13,103,{day(1, 0)},8.0,CCU,CCU")
    write(root, "hosp/patients.csv", "subject_id,gender,anchor_year,anchor_age",
          "100,M,2148,60", "101,F,2148,60", "102,F,2148,60", "103,F,2148,15")
    write(root, "hosp/admissions.csv", "hadm_id,admittime,deathtime",
          f"10,{day(1)},{day(10, 0)}", f"11,{day(1)},", f"12,{day(1)},", f"13,{day(1)},")
    write(root, "icu/chartevents.csv", "stay_id,subject_id,hadm_id,itemid,charttime,value,valuenum,storetime",
          f"1,100,10,226512,{day(1, 3)},70,70,", f"1,100,10,226512,{day(2, 3)},90,90,",
          f"1,100,10,225965,{day(12)},In use,,")
    # entry of stay 1 is 120 minutes after admission, so its prediction point is day 3, 02:00
    write(root, "hosp/labevents.csv",
          "labevent_id,subject_id,hadm_id,itemid,charttime,value,valuenum,valueuom",
          f"1,100,10,50912,{day(1, 3)},1.0,1.0,mg/dL",
          f"2,100,10,50912,{day(3, 3)},2.0,2.0,mg/dL",
          f"3,100,10,50912,{day(3, 4)},3.0,3.0,mg/dL",
          f"4,100,10,50912,{day(4, 3)},88.42,88.42,umol/L",
          f"5,100,10,51265,{day(3, 5)},150,150,K/uL",
          f"6,100,10,51265,{day(3, 1)},10,10,K/uL",
          f"7,100,10,51222,{day(5, 3)},bad,,g/dL")
    write(root, "hosp/d_labitems.csv", "itemid,label", "50912,Creatinine", "51265,Platelet Count", "51222,Hemoglobin")
    write(root, "icu/d_items.csv", "itemid,label", "227536,KCl (CRRT)")
    write(root, "hosp/prescriptions.csv", "hadm_id,subject_id,starttime,drug,dose_val_rx",
          f"10,100,{day(2)},Aspirin,81.12345", f"10,100,{day(30)},Late,1")
    write(root, "icu/inputevents.csv", "stay_id,hadm_id,subject_id,itemid,starttime,amount", f"1,10,100,227536,{day(13)},5")
    write(root, "icu/outputevents.csv", "hadm_id,subject_id,itemid,charttime,value,valueuom", f"10,100,226559,{day(3, 6)},40,ml")
    write(root, "icu/procedureevents.csv", "hadm_id,subject_id,itemid,starttime,value", f"10,100,1,{day(2)},1")
    write(root, "hosp/microbiologyevents.csv", "hadm_id,subject_id,charttime,org_name", f"10,100,{day(2)},E COLI")
    write(root, "hosp/diagnoses_icd.csv", "hadm_id,icd_code,icd_version",
          "10,0010,9", "10,A00,10", "10,B99X,10", "10,ZZZ,10", "13,0010,9")
    write(root, "ccs.csv", "'ICD-9-CM CODE','CCS LVL 1'", "'0010 ','1'", "'0020','15'", "'0030','17'")
    write(root, "gem.csv", '"icd10cm","icd9cm"', '"A00","0030"', '"B99","0020"', '"B991","0030"', '"B992","0030"', '"X","1","2"')
    write(root, "ed/edstays.csv", "stay_id,hadm_id,intime,outtime", f"900,10,{day(1)},{day(1, 1)}", f"901,,{day(1)},{day(1, 1)}")
    write(root, "ed/triage.csv", "stay_id,subject_id,acuity", "900,100,2", "901,100,3")
    write(root, "ed/diagnosis.csv", "stay_id,subject_id,icd_code,icd_title", "900,100,X,Chest pain")
    for name in ("medrecon", "pyxis", "vitalsign"):
        write(root, f"ed/{name}.csv", "stay_id,subject_id,charttime,name", f"900,100,{day(1)},x")
    return open_source(spark, "mimiciv", root, classes=f"{root}/ccs.csv", crosswalk=f"{root}/gem.csv")


def test_mimiciv_cohort(mimiciv):
    cohort = pipeline.build_cohort(mimiciv, Config(readmission=True))
    found = rows(cohort, "stay_id", "INTIME", "DEATHTIME", "LOS", "AGE", "weight", "readmission")
    assert found == [(1, 120.0, 12960.0, 6.0, 62.0, 80.0, 1), (2, 11520.0, 12960.0, 3.0, 62.0, 80.0, 0)]
    assert rows(load_stays(mimiciv), "stay_id") == [(1,), (2,), (4,), (5,)]


def test_mimiciv_labels(mimiciv):
    config = Config(mortality=(1, 7), los=(3, 7), diagnosis=True, in_icu_mortality=True)
    cohort = cohort_of(mimiciv, config)
    labelled = pipeline.build_labels(mimiciv, cohort, config)
    # medians: day one (2 + 3) / 2 = 2.5, day two 88.42 umol/L = 1.0 mg/dL; baseline 1.0
    assert labels_of(labelled, 1, "creatinine_1", "creatinine_2", "creatinine_3") == (2, 0, -1)
    # change 1.5 is right-closed: stage 1; urine 40 mL / 80 kg = 0.5: stage 1
    assert labels_of(labelled, 1, "urine_1", "AKI_1", "AKI_2") == (1, 1, -1)
    assert labels_of(labelled, 1, "platelets_1", "hb_3") == (1, -1)
    assert labels_of(labelled, 1, "los_3", "los_7", "mortality_1", "mortality_7", "in_icu_mortality") == (1, 0, 0, 1, 0)
    # 0010 -> 0; A00 -> 0030 -> 16 -> 15; B99X -> prefix B99, most frequent 0030 -> 15; ZZZ -> no class
    assert labels_of(labelled, 1, "diagnosis") == ([0, 15],)
    assert set(labelled.columns).isdisjoint({"admit_s", "stay_order", "exclusion_s"})


def test_mimiciv_exclusion_ends_renal_measures(mimiciv):
    write(mimiciv.root, "icu/procedureevents.csv", "hadm_id,subject_id,itemid,starttime,value",
          f"10,100,225441,{day(3, 4)},1")
    config = Config()
    labelled = pipeline.build_labels(mimiciv, cohort_of(mimiciv, config), config)
    # only the value before 04:00 counts: 2.0 -> right-closed class 1, change 1.0 -> stage 1
    assert labels_of(labelled, 1, "creatinine_1", "creatinine_2", "urine_1", "platelets_1") == (1, -1, -1, 1)


def test_exclusion_rules_scan_a_file_once(mimiciv):
    """Rules over one file are one predicate; each of them finds its rows, and a rule without a value hides none."""
    header = "stay_id,hadm_id,subject_id,itemid,charttime,value,valuenum,valueuom"
    cohort = saved(cohort_of(mimiciv, Config()), "cohort")
    write(mimiciv.root, "icu/chartevents.csv", header)
    before = clinical.exclusion_events(mimiciv, cohort).count()
    write(mimiciv.root, "icu/chartevents.csv", header,
          f"1,10,100,226499,{day(3, 4)},x,,", f"1,10,100,226499,{day(3, 5)},,,",
          f"1,10,100,225965,{day(3, 6)},In use,,", f"1,10,100,225965,{day(3, 7)},off,,", f"1,10,100,225965,{day(3, 8)},,,")
    assert [e.file for e in mimiciv.profile.exclusions].count("icu/chartevents") == 2
    found = clinical.exclusion_events(mimiciv, cohort)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan csv [subject_id#") == len({e.file for e in mimiciv.profile.exclusions})
    assert found.count() == before + 2


def test_mimiciv_events(mimiciv):
    config = Config(max_events=30, max_tokens=40, more_tables=True, visits=True)
    cohort = cohort_of(mimiciv, config)
    every = pipeline.encode_events(mimiciv, cohort, config)
    config = Config(max_events=3, max_tokens=40, more_tables=True, visits=True)
    encoded = pipeline.encode_events(mimiciv, cohort, config)
    latest = sorted(every.where("stay_id = 1").collect(), key=lambda r: (r["TIME"], r["tie"]))[-3:]
    assert rows(encoded.where("stay_id = 1"), "TIME", "original_text") == sorted((r["TIME"], r["original_text"]) for r in latest)
    texts = rows(every.where("stay_id = 1"), "TIME", "original_text", "codes")
    assert (-60.0, "diagnosis icd_title Chest pain", []) in texts
    assert (-120.0, "triage acuity 2", []) in texts
    assert (1320.0, "prescriptions drug Aspirin dose_val_rx 81.12345", []) in texts
    creatinine = [t for t in texts if t[2] == ["50912"]]
    assert creatinine == [(60.0, "labevents value 1.0 valuenum 1.0 valueuom mg/dL itemid Creatinine", ["50912"])]
    # stay 2 of the same admission sees the earlier events with negative times, at most three of them
    assert [r["TIME"] < 0 for r in encoded.where("stay_id = 2").collect()] == [True] * 3
    from stayline.operators.encode import build_vocabulary

    sequences = pipeline.build_sequences(cohort, encoded, config, build_vocabulary(encoded))
    packed = {r["stay_id"]: r for r in sequences.collect()}
    assert sorted(packed) == [1, 2]
    for r in packed.values():
        n = len(r["hi_input"])
        assert n == len(r["hi_type"]) == len(r["hi_place"]) == len(r["time"]) <= 3
        assert all(len(e) == 40 and e[0] == 101 for e in r["hi_input"])
        assert list(r["hi_start"]) == sorted(r["hi_start"]) and max(r["hi_start"]) <= n
        assert list(r["time"]) == sorted(r["time"])


def test_run_writes_everything(mimiciv, spark, tmp_path):
    dest = str(tmp_path / "out")
    config = Config(max_events=4, max_tokens=32, pred_hours=48)
    labelled = pipeline.run(mimiciv, config, dest)
    assert labelled.count() == 2
    stats = spark.read.option("header", True).csv(f"{dest}/label_stats")
    sums = {r["task"]: r["total"] for r in stats.groupBy("task").agg(F.sum(F.col("n").cast("int")).alias("total")).collect()}
    assert set(sums.values()) == {2}
    written = spark.read.option("header", True).csv(f"{dest}/labels")
    assert written.columns[0] == "stay_id" and "AKI_3" in written.columns and written.count() == 2
    sequences = spark.read.parquet(f"{dest}/sequences")
    assert sequences.count() == 2
    from stayline.sources.writers import read_stay

    assert rows(read_stay(spark, f"{dest}/sequences", 1), "stay_id") == [(1,)]
    assert pipeline.run(mimiciv, config, dest, reuse=True, verify_only=True).count() == 2


def test_word_profile_and_language(mimiciv, spark, tmp_path):
    counts = pipeline.word_profile(mimiciv, Config())
    found = {(r["table"], r["column"], r["word"]): r["cnt"] for r in counts.collect()}
    assert found[("prescriptions", "drug", "aspirin")] == 1
    assert found[("labevents", "itemid", "creatinine")] == 4
    assert not any(k[1] in ("hadm_id", "charttime") for k in found)
    text = spark.createDataFrame(
        [("the creatinine and the platelet count of the patient", "en"), ("der Kreatinin und die Werte nicht", "de")], "text string, lang string"
    )
    dest = str(tmp_path / "lang")
    classified = pipeline.run_language(mimiciv, Config(), text, ["de", "en"], dest)
    assert classified.where("word = 'creatinine'").select("lang").distinct().collect()[0][0] == "en"
    levels = spark.read.json(f"{dest}/language_distribution")
    total = counts.agg(F.sum("cnt")).collect()[0][0]
    per_level = {r["level"]: r["n"] for r in levels.groupBy("level").agg(F.sum("cnt").alias("n")).collect()}
    assert per_level == {"column": total, "table": total, "overall": total}


@pytest.fixture
def eicu(spark, tmp_path):
    root = str(tmp_path)
    write(root, "patient.csv",
          "patientunitstayid,patienthealthsystemstayid,uniquepid,unitvisitnumber,age,gender,hospitaladmitoffset,"
          "hospitaldischargeoffset,unitdischargeoffset,hospitaldischargestatus,admissionweight",
          "1,10,p-1,1,> 89,Male,-60,9000,7200,Expired,",
          "2,10,p-1,2,70,Male,-5000,9000,7200,Alive,50",
          "3,11,p-2,1,,Female,-10,9000,7200,Alive,50",
          "4,12,p-3,1,40,Female,-10,9000,7200,Alive,-1")
    # times are minutes since entry of the event's own stay
    write(root, "lab.csv", "labid,patientunitstayid,labresultoffset,labname,labresult",
          "1,1,2900,creatinine,1.2", "2,1,2910,creatinine,9", "3,1,2920,creatinine,2.0", "4,1,2930,creatinine,3.4",
          "5,1,10,creatinine,1.0", "6,2,0,sodium,140", "7,4,2900,creatinine,4", "8,1,2900,WBC x 1000,12")
    write(root, "medication.csv", "medicationid,patientunitstayid,drugstartoffset,drugname", "1,1,30,HEPARIN 5000 unit")
    write(root, "infusionDrug.csv", "infusiondrugid,patientunitstayid,infusionoffset,drugname", "1,1,40,x")
    write(root, "intakeOutput.csv",
          "patientunitstayid,intakeoutputoffset,celllabel,cellvaluenumeric,dialysistotal",
          "1,2900,Urine,4,0", "4,2905,Other,1,-500")
    write(root, "diagnosis.csv", "patientunitstayid,diagnosisstring,icd9code",
          '1,a|b|c,"001.0, A00"', "1,a|b|d,002.0", "1,a|b|e,002.0", "1,a|b|x|y,", "4,q|r,", "4,a|b|c,")
    write(root, "ccs.csv", "'ICD-9-CM CODE','CCS LVL 1'", "'0010','1'", "'0020','3'")
    write(root, "gem.csv", '"icd10cm","icd9cm"', '"A00","0010"')
    return open_source(spark, "eicu", root, classes=f"{root}/ccs.csv", crosswalk=f"{root}/gem.csv")


def test_eicu(eicu):
    config = Config(readmission=True, diagnosis=True, los=(4,), mortality=(1,))
    cohort = cohort_of(eicu, config)
    assert rows(cohort, "stay_id", "INTIME", "DEATHTIME", "AGE", "weight", "readmission") == [
        (1, 60.0, 9060.0, 300.0, 80.0, 1), (2, 5000.0, None, 70.0, 50.0, 0), (4, 10.0, None, 40.0, 72.5, 0),
    ]
    labelled = pipeline.build_labels(eicu, cohort, config)
    # four values 1.2, 2.0, 3.4, 9: the approximate median is the lower middle one
    assert labels_of(labelled, 1, "creatinine_1", "wbc_1", "urine_1", "AKI_1") == (2, 1, 3, 3)
    # stay 4 is dialysed at 2905, after its value at 2900; its patient has one stay only
    assert labels_of(labelled, 4, "creatinine_1") == (3,)
    # a|b|x|y: child a|b is voted 2 by its leaves c=0, d=2, e=2; q|r has no known prefix
    assert labels_of(labelled, 1, "diagnosis") == ([0, 2],)
    assert labels_of(labelled, 4, "diagnosis") == ([0],)
    # an event of stay 1 is seen by its sibling stay 2 at an earlier relative time
    encoded = pipeline.encode_events(eicu, cohort, config)
    assert rows(encoded.where("original_text LIKE 'medication%'"), "stay_id", "TIME", "original_text") == [
        (1, 30.0, "medication drugname HEPARIN 5000 unit"), (2, -4910.0, "medication drugname HEPARIN 5000 unit"),
    ]


def test_eicu_patient_with_several_stays_is_dropped_from_renal_measures(eicu):
    write(eicu.root, "intakeOutput.csv", "patientunitstayid,intakeoutputoffset,celllabel,cellvaluenumeric,dialysistotal",
          "2,8000,Other,1,5")
    config = Config()
    labelled = pipeline.build_labels(eicu, cohort_of(eicu, config), config)
    assert labels_of(labelled, 1, "creatinine_1", "AKI_1", "wbc_1") == (-1, -1, 1)


def test_umcdb(spark, tmp_path):
    root, ms = str(tmp_path), 60_000
    write(root, "admissions.csv",
          "admissionid,patientid,admissioncount,admittedat,dischargedat,lengthofstay,destination,gender",
          f"1,9,1,{10 * ms},{9000 * ms},120,Overleden,Man", f"2,9,2,{20000 * ms},{30000 * ms},12,Thuis,Vrouw", encoding="latin-1")
    write(root, "numericitems.csv", "admissionid,itemid,value,measuredat,unitid",
          f"1,6836,100,{3000 * ms},1", f"1,6836,500,{3100 * ms},1", f"1,7667,1,{3050 * ms},1",
          f"1,9960,5,{3000 * ms},1", f"1,8794,80,{3000 * ms},1")
    write(root, "listitems.csv", "admissionid,itemid,value,measuredat",
          f"1,18669,Neurologie - algemeen,{20 * ms}", f"1,13110,Non-operative cardiovasculair,{20 * ms}",
          f"1,1,Café blå,{20 * ms}", encoding="latin-1")
    write(root, "processitems.csv", "admissionid,itemid,start,stop", f"1,9162,{8000 * ms},1")
    for name, at in (("drugitems", "start"), ("freetextitems", "measuredat"), ("procedureorderitems", "registeredat")):
        write(root, f"{name}.csv", f"admissionid,{at},item", f"1,{15 * ms},thing")
    source = open_source(spark, "umcdb", root)
    config = Config(diagnosis=True)
    cohort = cohort_of(source, config)
    assert rows(cohort, "stay_id", "INTIME", "DEATHTIME", "LOS", "AGE", "weight") == [(1, 10.0, 9000.0, 5.0, 100.0, 80.0)]
    labelled = pipeline.build_labels(source, cohort, config)
    # 100 umol/L < 1.2 * 88.42; 500 comes after dialysis; hb 5 mmol/L is 8.06 g/dL
    assert labels_of(labelled, 1, "creatinine_1", "hb_1", "urine_1", "diagnosis") == (0, 1, 0, [0, 3])
    texts = [r[0] for r in rows(pipeline.encode_events(source, cohort, config), "original_text")]
    assert "listitems value Café blå" in texts
    assert ("drugitems item thing", 5.0) in rows(pipeline.encode_events(source, cohort, config), "original_text", "TIME")


def test_hirid(spark, tmp_path):
    root = str(tmp_path)
    write(root, "general_table.csv", "patientid,age,admissiontime,discharge_status",
          f"1,50,{day(1)},dead", f"2,50,{day(1)},alive", f"3,50,{day(1)},alive")
    write(root, "observation_tables/csv/part-0.csv", "patientid,datetime,variableid,value,status,type,entertime",
          f"1,{day(3, 1)},20000600,90,1,x,", f"1,{day(3, 2)},20000600,1000,1,x,", f"1,{day(3, 1)},10020000,15,1,x,",
          f"1,{day(3, 1)},9990002,190.0,1,x,")
    write(root, "observation_tables/csv/part-1.csv", "patientid,datetime,variableid,value,status,type,entertime",
          f"1,{day(1, 2)},10000400,60,1,x,", f"1,{day(1, 3)},10000400,62,1,x,", f"2,{day(2)},10000400,60,1,x,",
          f"1,{day(3, 2)},10002508,1.0,1,x,")
    write(root, "pharma_records/csv/part-0.csv", "patientid,pharmaid,givenat,givendose,infusionid", f"1,5,{day(6)},2.5,7", f"1,6,{day(1, 1)},0.00004,7")
    write(root, "hirid_variable_reference.csv", "ID,Source Table,Variable Name,Unit,Additional information",
          "20000600,Observation,Creatinine,umol/l,", "5,Pharma,Drug A,mg,", "6,Pharma,Drug B,,note", "6,Observation,Other,,")
    source = open_source(spark, "hirid", root)
    config = Config(diagnosis=True)
    cohort = cohort_of(source, config)
    assert rows(cohort, "stay_id", "INTIME", "LOS", "weight") == [(1, 0.0, 5.0, 60.0)]
    labelled = pipeline.build_labels(source, cohort, config)
    assert not [c for c in labelled.columns if c.startswith(("los_", "mortality_"))]
    # the value at 02:00 coincides with dialysis and is dropped; 15 / 60 kg = 0.25
    assert labels_of(labelled, 1, "creatinine_1", "urine_1", "AKI_1", "diagnosis") == (0, 2, 2, [0])
    encoded = pipeline.encode_events(source, cohort, config)
    assert rows(encoded.where("original_text LIKE 'pharma%'"), "TIME", "original_text", "codes") == [
        (60.0, "pharma_records givendose 0.00004 variableid Drug B Additional information note", ["6"])
    ]


def test_ehrshot(spark, tmp_path):
    root = str(tmp_path)
    write(root, "visit_detail.csv",
          "visit_detail_id,visit_occurrence_id,person_id,care_site_id,visit_detail_source_value,visit_detail_start_DATETIME,"
          "visit_detail_start_DATE,visit_detail_end_DATETIME,visit_detail_end_DATE",
          f"1,10,100,7,ward,{day(1, 1)},2150-01-01,{day(5, 1)},2150-01-05",
          f"2,11,101,8,intensive care,,2150-01-02,,2150-01-09",
          f"3,12,102,8,ward,{day(1)},,{day(9)},")
    write(root, "care_site.csv", "care_site_id,care_site_name", "7,MICU east", "8,clinic")
    write(root, "visit_occurrence.csv", "visit_occurrence_id,visit_start_DATE,visit_start_DATETIME",
          f"10,2150-01-01,{day(1)}", "11,2150-01-01,", "12,2150-01-01,")
    write(root, "person.csv", "person_id,gender_concept_id,year_of_birth,month_of_birth,day_of_birth,birth_DATETIME",
          "100,8507,2100,,,", "101,8532,2100,6,1,2100-06-01 00:00:00", "102,8532,2100,6,1,")
    write(root, "measurement.csv",
          "visit_detail_id,visit_occurrence_id,measurement_concept_id,value_as_number,unit_concept_id,measurement_DATETIME",
          f"2,11,3025315,100,8739.0,{day(2)}", f"1,10,3016723,2.5,8840,{day(3, 2)}", f"1,10,3016723,99,1,{day(3, 2)}",
          f"1,10,3016723,1.0,8840,{day(1, 2)}", f"1,10,3024929,90000,8647,{day(3, 2)}")
    write(root, "procedure_occurrence.csv",
          "visit_detail_id,visit_occurrence_id,procedure_DATETIME,procedure_DATE,procedure_source_value",
          "1,10,,2150-01-09,Renal CRRT start")
    for name, at in (("observation", "observation_DATETIME"), ("drug_exposure", "drug_exposure_start_DATETIME")):
        write(root, f"{name}.csv", f"visit_detail_id,visit_occurrence_id,{at},item", f"1,10,{day(1, 2)},x")
    source = open_source(spark, "ehrshot", root)
    config = Config()
    cohort = cohort_of(source, config)
    found = rows(cohort.withColumn("weight", F.round("weight", 4)), "stay_id", "INTIME", "LOS", "DEATHTIME", "weight")
    assert found == [(1, 60.0, 4.0, None, 80.0), (2, 1440.0, 7.0, None, 45.3592)]
    labelled = pipeline.build_labels(source, cohort, config)
    # change (2.5 - 1) / 1 = 1.5 is left-closed: stage 2
    assert labels_of(labelled, 1, "creatinine_1", "platelets_1", "AKI_1") == (2, 2, 2)
    assert len(rows(pipeline.encode_events(source, cohort, config), "TIME")) == 3 + 1


def test_nwicu(spark, tmp_path):
    root = str(tmp_path)
    write(root, "nw_icu/icustays.csv", "stay_id,hadm_id,subject_id,intime,outtime,los", f"1,10,100,{day(1, 2)},{day(7)},6.0")
    write(root, "nw_hosp/patients.csv", "subject_id,gender,anchor_year,anchor_age", "100,F,2140,50")
    write(root, "nw_hosp/admissions.csv", "hadm_id,admittime,deathtime", f"10,{day(1)},")
    write(root, "nw_icu/chartevents.csv", "stay_id,hadm_id,itemid,charttime,valuenum,valueuom", f"1,10,326531,{day(1)},2000,Ounce")
    write(root, "nw_hosp/labevents.csv", "labevent_id,hadm_id,itemid,charttime,valuenum,valueuom",
          f"1,10,100002,{day(3, 3)},2.0,mg/dL", f"2,10,100002,{day(1, 3)},0.5,mg/dL", f"3,10,100014,{day(3, 3)},60000,/uL",
          f"4,10,100016,{day(3, 3)},5,K/uL")
    write(root, "nw_icu/procedureevents.csv", "hadm_id,itemid,starttime,value", f"10,704890,{day(4)},1")
    for folder in ("nw_hosp/d_labitems", "nw_icu/d_items"):
        write(root, f"{folder}.csv", "itemid,label", "100002,Creatinine")
    source = open_source(spark, "nwicu", root)
    config = Config(readmission=True)
    cohort = cohort_of(source, config)
    assert rows(cohort.withColumn("weight", F.round("weight", 3)), "stay_id", "INTIME", "AGE", "weight", "readmission") == [
        (1, 120.0, 60.0, 56.699, 0)
    ]
    labelled = pipeline.build_labels(source, cohort, config)
    assert labels_of(labelled, 1, "creatinine_1", "platelets_1", "wbc_1", "urine_1", "AKI_1") == (2, 2, 1, -1, 4)


def test_sicdb(spark, tmp_path):
    root = str(tmp_path)
    write(root, "cases.csv",
          "CaseID,PatientID,ICUOffset,TimeOfStay,OffsetOfDeath,HospitalDischargeType,DischargeState,AgeOnAdmission,WeightOnAdmission",
          "1,9,0,1000,,2028,1,95,80000", "2,9,600,864000,777600,1,1,50,", "3,8,0,0,,1,1,50,70")
    write(root, "unitlog.csv", "CaseID,Offset,HospitalUnit", "1,100,5", "1,600,1", "1,1200,1", "1,432600,5", "1,500000,1")
    write(root, "d_references.csv", "ReferenceGlobalID,ReferenceValue,ReferenceName,ReferenceDescription,ReferenceUnit",
          "1,INIC,HospitalUnit,,", "5,WARD,HospitalUnit,,", "367,Creatinine,Laboratory,,mg/dl")
    hours = lambda h: 600 + h * 3600
    write(root, "laboratory.csv", "id,CaseID,Offset,LaboratoryID,LaboratoryValue",
          f"1,1,{hours(49)},367,1.2", f"2,1,{hours(1)},367,1.0", f"3,1,{hours(50)},314,20")
    write(root, "data_float_h.csv", "id,CaseID,Offset,DataID,Val,rawdata", f"1,1,{hours(49)},725,8,x")
    for name in ("medication", "data_range"):
        code = "DrugID" if name == "medication" else "DataID"
        write(root, f"{name}.csv", f"id,CaseID,Offset,{code},note", f"1,1,{hours(2)},77,x")
    source = open_source(spark, "sicdb", root)
    assert rows(sicdb_blocks(source), "stay_id", "block_in", "block_out") == [(1, 600, 432600)]
    config = Config()
    cohort = cohort_of(source, config)
    assert rows(cohort, "stay_id", "INTIME", "LOS", "AGE", "DEATHTIME", "weight") == [
        (1, 10.0, 5.0, 90.0, 1000 / 60, 80.0), (2, 10.0, 10.0, 50.0, 12960.0, 80.0),
    ]
    labelled = pipeline.build_labels(source, cohort, config)
    # right-closed: 1.2 -> 0, 20 -> 4; urine 8 / 80 = 0.1 -> 3
    assert labels_of(labelled, 1, "creatinine_1", "platelets_1", "urine_1", "AKI_1") == (0, 4, 3, 3)
    encoded = pipeline.encode_events(source, cohort, config)
    assert (60.0, "laboratory LaboratoryValue 1.0 LaboratoryID Creatinine ReferenceName Laboratory ReferenceUnit mg/dl", ["367"]) in rows(
        encoded, "TIME", "original_text", "codes"
    )


def test_sicdb_without_unit_log(spark, tmp_path):
    root = str(tmp_path)
    write(root, "cases.csv",
          "CaseID,PatientID,ICUOffset,TimeOfStay,OffsetOfDeath,HospitalDischargeType,DischargeState,AgeOnAdmission,WeightOnAdmission",
          "2,9,600,864000,,1,1,50,")
    found = load_stays(open_source(spark, "sicdb", root))
    assert rows(found, "stay_id", "INTIME", "LOS", "weight") == [(2, 10.0, 10.0, 72.5)]


@pytest.mark.parametrize("name", ALL)
def test_profiles_load(name):
    profile = load_profile(name)
    assert isinstance(profile, Profile) and profile.tables and profile.measurements
    assert sum(len(load_profile(n).tables) for n in ALL) == 42


def test_unknown_source_and_unit():
    with pytest.raises(KeyError):
        load_profile("nothing")
    with pytest.raises(ValueError):
        load_profile("eicu").event_tables(visits=True)
