"""Measurements, exclusion events and diagnoses of a source in the operators' common shape."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.timeframe import as_double, as_timestamp, epoch_seconds, offset_minutes
from stayline.functions.values import normalise_by_unit_id, normalise_by_unit_text
from stayline.operators import diagnosis, labs
from stayline.sources.profile import Exclusion, Measurements, Source
from stayline.sources.readers import read_classes, read_dirty_csv
from stayline.sources.stays import load_stays

KEYS = {"stay": "stay_id", "hadm": "hadm_id", "patient": "patient_id"}


def clock_seconds(time: Column, unit: str) -> Column:
    """Seconds on the source's clock; for minutes, seconds since unit entry."""
    if unit == "abs":
        return epoch_seconds(as_timestamp(time))
    return offset_minutes(as_double(time), unit) * 60


def on_admission_clock(rows: DataFrame, cohort: DataFrame, unit: str) -> DataFrame:
    """Rows timed since entry of their own stay, moved to the clock of the admission."""
    if unit != "min":
        return rows
    entry = cohort.select("stay_id", "hadm_id", "INTIME")
    timed = rows.drop("hadm_id").join(entry, "stay_id")
    return timed.withColumn("clock_s", F.round(F.col("clock_s") / 60 + F.col("INTIME")) * 60).drop("INTIME")


def read_measurements(source: Source, spec: Measurements, cohort: DataFrame) -> DataFrame:
    """Wanted rows of one table with (join key, code, clock_s, value); code is the measure."""
    columns = [source.profile.keys[spec.key], spec.code, spec.time, spec.value]
    raw = source.keyed(spec.file, *dict.fromkeys(columns + ([spec.unit_column] if spec.unit_column else [])))
    listed = [c for own in spec.codes.values() for c in own]
    rows = raw.where(labs.has_code(raw, spec.code, listed)).select(
        KEYS[spec.key],
        labs.measure_of(f"`{spec.code}`", spec.codes).alias("code"),
        clock_seconds(F.col(spec.time), spec.unit).alias("clock_s"),
        as_double(F.col(spec.value)).alias("value"),
        *([F.col(spec.unit_column).alias("_unit")] if spec.unit_column else []),
    ).where("code IS NOT NULL AND value IS NOT NULL AND clock_s IS NOT NULL")
    if spec.unit_column:
        rows = rows.withColumn("value", normalised(source, list(spec.codes))).where("value IS NOT NULL").drop("_unit")
    placed = on_admission_clock(rows, cohort, spec.unit)
    return placed.select(source.profile.join, "code", "clock_s", "value")


def normalised(source: Source, measures: list[str]) -> Column:
    profile = source.profile
    chain = None
    for m in measures:
        if profile.unit_id:
            divisors = {int(k): v for k, v in profile.unit_id[m].items()}
            scaled = normalise_by_unit_id(F.col("value"), as_double(F.col("_unit")), divisors)
        else:
            scaled = normalise_by_unit_text(F.col("value"), F.col("_unit"), m, profile.unit_text["scaled_counts"])
        is_m = F.col("code") == m
        chain = F.when(is_m, scaled) if chain is None else chain.when(is_m, scaled)
    return chain


def measurements(source: Source, cohort: DataFrame) -> DataFrame:
    parts = [read_measurements(source, spec, cohort) for spec in source.profile.measurements]
    return reduce(DataFrame.unionByName, parts)


def counts(spec: Exclusion, raw: DataFrame) -> Column:
    """Whether a row counts as an exclusion event."""
    listed = labs.has_code(raw, spec.code, list(spec.codes)) if spec.code and spec.rule != "keyword" else F.lit(True)
    value = F.col(spec.value) if spec.value else None
    if spec.rule == "keyword":
        return F.col(spec.code).rlike("(?i)" + "|".join(spec.codes))
    conditions = {
        "listed": lambda: F.lit(True),
        "present": lambda: value.isNotNull(),
        "equals": lambda: value == spec.equals,
        "number": lambda: as_double(value) == float(spec.equals),
        "positive": lambda: as_double(value) > 0,
        "nonzero": lambda: as_double(value) != 0,
    }
    return listed & conditions[spec.rule]()


def exclusion_events(source: Source, cohort: DataFrame) -> DataFrame:
    """Exclusion events with their key and clock_s, over all tables of the source.

    Rules that read the same file by the same key and time are one predicate, so that a file is scanned once.
    """
    scans: dict[tuple, list[Exclusion]] = {}
    for spec in source.profile.exclusions:
        scans.setdefault((spec.file, spec.key, spec.time, spec.time_else, spec.unit), []).append(spec)
    parts = []
    for (file, key, time, time_else, unit), specs in scans.items():
        used = [source.profile.keys[key], *[c for s in specs for c in (s.code, s.value)], time, time_else]
        raw = source.keyed(file, *dict.fromkeys(c for c in used if c))
        clock = clock_seconds(F.col(time), unit)
        if time_else:
            clock = F.coalesce(clock, clock_seconds(F.col(time_else), unit))
        any_rule = reduce(or_, [counts(spec, raw) for spec in specs])
        rows = raw.where(any_rule).select(KEYS[key], clock.alias("clock_s")).where("clock_s IS NOT NULL")
        parts.append(on_admission_clock(rows, cohort, unit).select(KEYS[key], "clock_s"))
    return reduce(DataFrame.unionByName, parts)


def with_exclusion(source: Source, cohort: DataFrame) -> DataFrame:
    """Cohort with ``exclusion_s``, and ``excluded`` where whole patients are dropped.

    Where events are timed from unit entry, all stays of the source are looked at, not only the
    cohort: a patient with several stays drops out even if only one of them is in the cohort.
    """
    key = KEYS[source.profile.exclusions[0].key]
    if all(spec.unit != "min" for spec in source.profile.exclusions):
        return cohort.join(labs.first_exclusion(exclusion_events(source, cohort), key), key, "left")
    stays = load_stays(source)
    found = exclusion_events(source, stays)
    patients = stays.select("stay_id", "patient_id")
    affected = found.select("stay_id").join(patients, "stay_id").select("patient_id")
    dropped = labs.multi_stay_excluded(patients, affected).withColumn("excluded", F.lit(True))
    return cohort.join(labs.first_exclusion(found, key), key, "left").join(dropped, "patient_id", "left")


def diagnosis_sets(source: Source, cohort: DataFrame) -> DataFrame:
    """Cohort with the sorted diagnosis categories of each stay or admission."""
    return DIAGNOSES[source.profile.name](source, cohort)


def _crosswalk(source: Source) -> DataFrame:
    return read_dirty_csv(source.spark, source.crosswalk, ["icd10cm", "icd9cm"])


def _mimiciv(source: Source, cohort: DataFrame) -> DataFrame:
    rows = source.keyed("hosp/diagnoses_icd").select("hadm_id", "icd_code", "icd_version")
    current = F.col("icd_version") == "9"
    wanted = rows.where(F.col("icd_version") == "10").select(F.col("icd_code").alias("code"))
    mapping = diagnosis.crosswalk_codes(wanted, _crosswalk(source), order="_line")
    converted = diagnosis.convert_codes(rows, mapping, "icd_code", current, "code")
    classed = converted.join(read_classes(source.spark, source.classes), "code").withColumn(
        "category", diagnosis.without_rare_class(F.col("category"))
    )
    return diagnosis.attach_sets(cohort, diagnosis.category_sets(classed, "hadm_id"), "hadm_id", "inner")


def _eicu(source: Source, cohort: DataFrame) -> DataFrame:
    rows = source.keyed("diagnosis", "patientunitstayid", "diagnosisstring", "icd9code")
    classes = read_classes(source.spark, source.classes)
    first = rows.where(F.col("icd9code").isNotNull()).groupBy("diagnosisstring").agg(F.min("icd9code").alias("_codes"))
    plain = F.transform(F.split("_codes", ","), lambda c: F.replace(F.trim(c), F.lit("."), F.lit("")))
    coded = first.select(F.col("diagnosisstring").alias("path"), F.posexplode(plain).alias("at", "code"))
    direct = coded.join(classes, "code", "left")
    foreign = direct.where(F.col("category").isNull()).select("path", "at", "code")
    mapping = diagnosis.crosswalk_codes(foreign, _crosswalk(source), order="_line")
    through = foreign.join(mapping, "code").select("path", "at", F.col("converted").alias("code")).join(classes, "code")
    known = direct.where(F.col("category").isNotNull()).select("path", "at", "category").unionByName(
        through.select("path", "at", "category")
    )
    # the last code of a path's list that has a category counts
    known = known.groupBy("path").agg(F.max_by("category", "at").alias("category"))
    paths = rows.select(F.col("diagnosisstring").alias("path"))
    named = diagnosis.path_categories(paths, known)
    placed = (
        rows.select("stay_id", F.col("diagnosisstring").alias("path"))
        .join(named, "path")
        .join(cohort.select("stay_id", "hadm_id"), "stay_id")
        .withColumn("category", diagnosis.without_rare_class(F.col("category")))
    )
    return diagnosis.attach_sets(cohort, diagnosis.category_sets(placed, "hadm_id"), "hadm_id")


def _umcdb(source: Source, cohort: DataFrame) -> DataFrame:
    rows = source.keyed("listitems", "admissionid", "itemid", "value").where(
        F.col("itemid").isin(*diagnosis.SPECIALTY_ITEMS)
    )
    key = diagnosis.specialty_key(F.col("value"), F.col("itemid").isin(*diagnosis.SPECIALTY_SUFFIXED))
    classed = rows.select("stay_id", diagnosis.literal_category(key, diagnosis.SPECIALTY_CATEGORY).alias("category"))
    return diagnosis.attach_sets(cohort, diagnosis.category_sets(classed, "stay_id"), "stay_id")


def _hirid(source: Source, cohort: DataFrame) -> DataFrame:
    rows = source.keyed("observation_tables/csv", "patientid", "variableid", "value").where(
        F.col("variableid").isin(*diagnosis.ADMISSION_GROUP_ITEMS)
    )
    group = as_double(F.col("value")).cast("int")
    classed = rows.select(
        "stay_id", diagnosis.literal_category(group, diagnosis.ADMISSION_GROUP_CATEGORY).alias("category")
    )
    return diagnosis.attach_sets(cohort, diagnosis.category_sets(classed, "stay_id"), "stay_id")


DIAGNOSES = {"mimiciv": _mimiciv, "eicu": _eicu, "umcdb": _umcdb, "hirid": _hirid}
