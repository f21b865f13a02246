"""Stays of each source with the canonical cohort columns.

Columns: stay_id, hadm_id and patient_id (where the source has them), ADMITTIME, admit_s, INTIME,
DEATHTIME (minutes since admission), LOS (days), AGE, weight (kg) and stay_order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.timeframe import (
    age_from_anchor, age_from_birth, as_double, as_long, as_timestamp, birth_date, epoch_seconds, whole_minutes_between,
)
from stayline.functions.values import KG_PER_LB, KG_PER_OUNCE_ROUNDED, KG_PER_OZ, impute_weight, mass_in_kg
from stayline.operators import cohort as ops
from stayline.operators.quantiles import approximate_median
from stayline.sources.profile import Source
from stayline.sources.readers import pick_column, read_optional

# Items and codes of the normalisers.
MIMICIV_WEIGHT_ITEM = "226512"
NWICU_WEIGHT_ITEM = "326531"
HIRID_WEIGHT_ITEM = "10000400"
HIRID_WEIGHT_OTHER = 75.0
EHRSHOT_WEIGHT_CONCEPTS = ("3025315", "3006322", "3013762")
EHRSHOT_LB, EHRSHOT_OZ = 8739, 9373
EHRSHOT_MALE, EHRSHOT_FEMALE = 8507, 8532
EHRSHOT_UNIT_NAME = "(?i)ICU|Intensive Care|Critical Care"
EHRSHOT_SITE_NAME = "(?i)ICU|CCU|CICU|MICU|SICU|NICU|PICU|Critical Care"
SICDB_UNITS = ("INIC", "INBD", "INID", "CWIN", "INCV", "CWCV")
SICDB_DIED_DISCHARGE, SICDB_DIED_STATE = "2028", "2215"
UMCDB_WEIGHT_COLUMNS = ["weight", "Weight", "admissionweight", "admissionWeight", "weightvalue", "actualweight"]
UMCDB_SEX_COLUMNS = ["gender", "Gender", "sex", "Sex"]
EICU_OLD_AGE, EICU_OLD_AGE_VALUE = "> 89", 300
UMCDB_AGE = 100


def load_stays(source: Source) -> DataFrame:
    return NORMALISERS[source.profile.name](source)


def _text(df: DataFrame, *names: str):
    """First of the columns the table has, as text; null if it has none."""
    found = pick_column(df, list(names))
    return F.lit(None).cast("string") if found is None else found.cast("string")


def _anchored(source: Source, folder: str, unit: str) -> DataFrame:
    """Stays with admission and patient columns where ages are anchored to a year."""
    admissions = source.keyed(f"{folder}/admissions").select(
        "hadm_id", as_timestamp(F.col("admittime")).alias("ADMITTIME"), as_timestamp(F.col("deathtime")).alias("_died")
    )
    patients = source.keyed(f"{folder}/patients")
    sex = _text(patients, "gender").alias("_sex")
    anchored = patients.select(
        "patient_id", sex, as_long(F.col("anchor_year")).alias("_year"), as_long(F.col("anchor_age")).alias("_age")
    )
    stays = source.keyed(f"{unit}/icustays").withColumn("_in", as_timestamp(F.col("intime")))
    if "first_careunit" in stays.columns and source.profile.name == "mimiciv":
        stays = stays.where(F.col("first_careunit") == F.col("last_careunit"))
    joined = (
        stays.select("stay_id", "hadm_id", "patient_id", "_in", as_double(F.col("los")).alias("LOS"))
        .join(admissions, "hadm_id", "left")
        .join(anchored, "patient_id", "left")
    )
    intime = whole_minutes_between(F.col("ADMITTIME"), F.col("_in")).cast("double")
    return joined.withColumns(
        {
            "admit_s": epoch_seconds(F.col("ADMITTIME")),
            "INTIME": intime,
            "DEATHTIME": whole_minutes_between(F.col("ADMITTIME"), F.col("_died")).cast("double"),
            "AGE": age_from_anchor(F.col("_in"), F.col("_year"), F.col("_age")).cast("double"),
            "stay_order": intime,
        }
    )


def _with_weight(stays: DataFrame, weights: DataFrame, male, female, positive: bool) -> DataFrame:
    filled = impute_weight(F.col("weight"), male, female, positive)
    return stays.join(weights, "stay_id", "left").withColumn("weight", filled)


def mimiciv(source: Source) -> DataFrame:
    measured = source.keyed("icu/chartevents", "stay_id", "itemid", "valuenum").where(
        F.col("itemid") == MIMICIV_WEIGHT_ITEM
    )
    weights = ops.mean_per_stay(measured, as_double(F.col("valuenum")))
    stays = _anchored(source, "hosp", "icu")
    return _with_weight(stays, weights, F.col("_sex") == "M", F.col("_sex") == "F", False).drop("_in", "_died", "_year", "_age", "_sex")


def nwicu(source: Source) -> DataFrame:
    measured = source.keyed("nw_icu/chartevents", "stay_id", "itemid", "valuenum", "valueuom").where(
        F.col("itemid") == NWICU_WEIGHT_ITEM
    )
    kg = mass_in_kg(as_double(F.col("valuenum")), F.lower("valueuom"), {"ounce": KG_PER_OUNCE_ROUNDED})
    weights = ops.mean_per_stay(measured, kg)
    stays = _anchored(source, "nw_hosp", "nw_icu")
    return _with_weight(stays, weights, F.col("_sex") == "M", F.col("_sex") == "F", False).drop("_in", "_died", "_year", "_age", "_sex")


def eicu(source: Source) -> DataFrame:
    raw = source.keyed("patient").where(F.col("age").isNotNull())
    age = F.when(F.col("age") == EICU_OLD_AGE, EICU_OLD_AGE_VALUE).otherwise(as_long(F.col("age")))
    admit, leave = as_double(F.col("hospitaladmitoffset")), as_double(F.col("hospitaldischargeoffset"))
    sex = F.upper(_text(raw, "gender"))
    weight = as_double(_text(raw, "admissionweight", "admissionWeight"))
    return raw.select(
        "stay_id",
        "hadm_id",
        "patient_id",
        F.lit(0).alias("ADMITTIME"),
        F.lit(0).cast("bigint").alias("admit_s"),
        (-admit).alias("INTIME"),
        F.when(F.col("hospitaldischargestatus") == "Expired", leave - admit).alias("DEATHTIME"),
        (as_double(F.col("unitdischargeoffset")) / 60 / 24).alias("LOS"),
        age.cast("double").alias("AGE"),
        impute_weight(weight, sex.isin("M", "MALE"), sex.isin("F", "FEMALE")).alias("weight"),
        as_long(F.col("unitvisitnumber")).alias("stay_order"),
    )


def umcdb(source: Source) -> DataFrame:
    raw = source.keyed("admissions")
    sex = F.upper(_text(raw, *UMCDB_SEX_COLUMNS))
    weight = as_double(_text(raw, *UMCDB_WEIGHT_COLUMNS))
    discharged = as_double(F.col("dischargedat")) / 1000 / 60
    return raw.select(
        "stay_id",
        "patient_id",
        F.lit(0).alias("ADMITTIME"),
        F.lit(0).cast("bigint").alias("admit_s"),
        (as_double(F.col("admittedat")) / 1000 / 60).alias("INTIME"),
        F.when(F.col("destination") == "Overleden", discharged).alias("DEATHTIME"),
        (as_double(F.col("lengthofstay")) / 24).alias("LOS"),
        F.lit(float(UMCDB_AGE)).alias("AGE"),
        impute_weight(weight, sex.startswith("M"), sex.startswith("F")).alias("weight"),
        as_long(F.col("admissioncount")).alias("stay_order"),
    )


def hirid(source: Source) -> DataFrame:
    general = source.keyed("general_table").select(
        "stay_id",
        as_timestamp(F.col("admissiontime")).alias("ADMITTIME"),
        F.when(F.col("discharge_status") == "dead", 1.0).alias("DEATHTIME"),
        as_double(F.col("age")).alias("AGE"),
    )
    timed = []
    for table in source.profile.tables:
        df = source.keyed(table.file, source.profile.keys["stay"], table.time)
        timed.append((df.withColumn("_at", as_timestamp(F.col(table.time))), "stay_id", "_at"))
    observed = source.keyed("observation_tables/csv", "patientid", "variableid", "value")
    weights = approximate_median(
        observed.where(F.col("variableid") == HIRID_WEIGHT_ITEM).withColumn("weight", as_double(F.col("value"))),
        ["stay_id"], "weight", "weight",
    )
    return (
        ops.los_from_events(general, timed)
        .drop("last_time")
        .join(weights, "stay_id", "left")
        .withColumns(
            {
                "weight": F.coalesce("weight", F.lit(HIRID_WEIGHT_OTHER)),
                "admit_s": epoch_seconds(F.col("ADMITTIME")),
                "INTIME": F.lit(0.0),
            }
        )
    )


def ehrshot(source: Source) -> DataFrame:
    sites = source.table("care_site", "care_site_id", "care_site_name")
    details = source.keyed("visit_detail").join(sites, "care_site_id", "left")
    in_unit = F.coalesce("visit_detail_source_value", F.lit("")).rlike(EHRSHOT_UNIT_NAME) | F.coalesce(
        "care_site_name", F.lit("")
    ).rlike(EHRSHOT_SITE_NAME)
    visits = source.keyed("visit_occurrence", "visit_occurrence_id", "visit_start_DATE", "visit_start_DATETIME").select(
        "hadm_id", as_timestamp(F.coalesce("visit_start_DATETIME", "visit_start_DATE")).alias("ADMITTIME")
    )
    stays = (
        details.where(in_unit)
        .select(
            "stay_id",
            "hadm_id",
            "patient_id",
            as_timestamp(F.coalesce("visit_detail_start_DATETIME", "visit_detail_start_DATE")).alias("_in"),
            as_timestamp(F.coalesce("visit_detail_end_DATETIME", "visit_detail_end_DATE")).alias("_out"),
        )
        .join(visits, "hadm_id", "left")
        .dropna(subset=["_in", "_out", "ADMITTIME"])
    )
    born = birth_date(
        as_timestamp(F.col("birth_DATETIME")),
        as_long(F.col("year_of_birth")),
        as_long(F.col("month_of_birth")),
        as_long(F.col("day_of_birth")),
    )
    people = source.keyed("person").select("patient_id", as_long(F.col("gender_concept_id")).alias("_sex"), born.alias("_born"))
    deaths = read_optional(
        source.spark, source.path("death"), "person_id string, death_DATE string, death_DATETIME string"
    ).groupBy(F.col("person_id").alias("patient_id")).agg(
        F.min(as_timestamp(F.coalesce("death_DATETIME", "death_DATE"))).alias("_died")
    )
    measured = source.keyed(
        "measurement", "visit_detail_id", "measurement_concept_id", "value_as_number", "unit_concept_id"
    ).where(F.col("measurement_concept_id").isin(*EHRSHOT_WEIGHT_CONCEPTS))
    kg = mass_in_kg(
        as_double(F.col("value_as_number")), as_double(F.col("unit_concept_id")), {EHRSHOT_LB: KG_PER_LB, EHRSHOT_OZ: KG_PER_OZ}
    )
    joined = stays.join(people, "patient_id", "left").join(deaths, "patient_id", "left")
    intime = whole_minutes_between(F.col("ADMITTIME"), F.col("_in")).cast("double")
    shaped = joined.withColumns(
        {
            "admit_s": epoch_seconds(F.col("ADMITTIME")),
            "INTIME": intime,
            "DEATHTIME": whole_minutes_between(F.col("ADMITTIME"), F.col("_died")).cast("double"),
            "LOS": (epoch_seconds(F.col("_out")) - epoch_seconds(F.col("_in"))) / 86_400,
            "AGE": age_from_birth(F.col("_in"), F.col("_born")),
            "stay_order": intime,
        }
    )
    weights = ops.mean_per_stay(measured, kg)
    filled = _with_weight(shaped, weights, F.col("_sex") == EHRSHOT_MALE, F.col("_sex") == EHRSHOT_FEMALE, True)
    return filled.drop("_in", "_out", "_died", "_sex", "_born")


def sicdb_blocks(source: Source) -> DataFrame:
    """First in-unit block per case from the unit log, if the source ships one."""
    log = read_optional(source.spark, source.path("unitlog"), "CaseID string, Offset string, HospitalUnit string")
    references = read_optional(
        source.spark, source.path("d_references"),
        "ReferenceGlobalID string, ReferenceValue string, ReferenceName string",
    )
    units = references.where(F.col("ReferenceName") == "HospitalUnit").select(
        F.col("ReferenceGlobalID").alias("HospitalUnit"), F.col("ReferenceValue").isin(*SICDB_UNITS).alias("_listed")
    )
    # no unit table: every entry is in the unit; none of the known names: every listed unit is
    any_listed = units.agg(F.max("_listed")).scalar()
    in_unit = (
        F.when(F.col("_any").isNull(), F.lit(True))
        .when(F.col("_any"), F.coalesce("_listed", F.lit(False)))
        .otherwise(F.col("_listed").isNotNull())
    )
    marked = (
        log.select(as_long(F.col("CaseID")).alias("stay_id"), as_double(F.col("Offset")).cast("bigint").alias("Offset"), "HospitalUnit")
        .join(units, "HospitalUnit", "left")
        .withColumn("_any", any_listed)
    )
    return ops.first_block(marked, in_unit, "stay_id", "Offset")


def sicdb(source: Source) -> DataFrame:
    cases = source.keyed("cases")
    start = F.coalesce("block_in", as_double(F.col("ICUOffset")).cast("bigint"), F.lit(0))
    stay_seconds = F.coalesce(as_double(F.col("TimeOfStay")), F.lit(0.0))
    joined = cases.join(sicdb_blocks(source), "stay_id", "left").withColumn("_start", start)
    joined = joined.withColumn("_end", F.coalesce("block_out", F.col("_start") + stay_seconds.cast("bigint")))
    died = (F.col("HospitalDischargeType") == SICDB_DIED_DISCHARGE) | (F.col("DischargeState") == SICDB_DIED_STATE)
    weight = as_double(_text(cases, "WeightOnAdmission"))
    shaped = joined.where(F.col("_end") > F.col("_start")).select(
        "stay_id",
        F.col("stay_id").alias("hadm_id"),
        "patient_id",
        F.lit(0).alias("ADMITTIME"),
        F.lit(0).cast("bigint").alias("admit_s"),
        (F.col("_start") / 60.0).alias("INTIME"),
        F.coalesce(as_double(F.col("OffsetOfDeath")) / 60.0, F.when(died, stay_seconds / 60.0)).alias("DEATHTIME"),
        ((F.col("_end") - F.col("_start")) / 86_400.0).alias("LOS"),
        F.least(as_double(F.col("AgeOnAdmission")), F.lit(90.0)).alias("AGE"),
        F.when(weight > 500, weight / 1000.0).otherwise(weight).alias("weight"),
        (F.col("_start") / 60.0).alias("stay_order"),
    )
    return ops.impute_with_median(shaped, "weight", 72.5)


NORMALISERS = {
    "mimiciv": mimiciv,
    "eicu": eicu,
    "umcdb": umcdb,
    "hirid": hirid,
    "ehrshot": ehrshot,
    "nwicu": nwicu,
    "sicdb": sicdb,
}
