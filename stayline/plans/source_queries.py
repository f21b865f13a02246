"""Registered queries of the source normalisers: general tables in each source's columns, all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.plans.catalog import query
from stayline.plans.views import table
from stayline.session import scratch_path
from stayline.sources import clinical
from stayline.sources.profile import Exclusion, Source, load_profile
from stayline.sources.stays import load_stays

CLOCK = "date_format({0}, 'yyyy-MM-dd HH:mm:ss')"


def source_of(spark, name: str, frames: dict) -> Source:
    """A source whose files are the given tables, every column as text, as in CSV."""
    text = {f: df.select([F.col(c).cast("string").alias(c) for c in df.columns]) for f, df in frames.items()}
    return Source(spark, "", load_profile(name), frames=text)


def anchored_frames(spark, d, hosp: str, icu: str, item: str) -> dict:
    """Orders as admissions with one stay each, customers as patients, lines as chart events."""
    orders = table(spark, d, "orders")
    entry = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 100 AS int))"
    return {
        f"{hosp}/admissions": orders.selectExpr(
            "o_orderkey AS hadm_id", f"{CLOCK.format('o_orderdate')} AS admittime",
            f"CASE WHEN o_orderstatus = 'F' THEN {CLOCK.format('o_orderdate + make_dt_interval(10)')} END AS deathtime",
        ),
        f"{hosp}/patients": table(spark, d, "customer").selectExpr(
            "c_custkey AS subject_id", "CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender",
            "'1980' AS anchor_year", "c_nationkey + 20 AS anchor_age",
        ),
        f"{icu}/icustays": orders.selectExpr(
            "o_orderkey * 10 AS stay_id", "o_orderkey AS hadm_id", "o_custkey AS subject_id", f"{CLOCK.format(entry)} AS intime",
            "o_orderkey % 9 AS los", "'A' AS first_careunit",
            "CASE WHEN o_orderkey % 5 = 0 THEN 'B' ELSE 'A' END AS last_careunit",
        ),
        f"{icu}/chartevents": table(spark, d, "lineitem").selectExpr(
            "l_orderkey * 10 AS stay_id", f"CASE WHEN l_linenumber % 2 = 0 THEN '{item}' ELSE '1' END AS itemid",
            "l_quantity + 40 AS valuenum", "CASE WHEN l_linenumber = 4 THEN 'Ounce' ELSE 'kg' END AS valueuom",
        ),
    }


def shown(stays, *more: str):
    return stays.select("stay_id", *more, "INTIME", "DEATHTIME", F.round("LOS", 6).alias("LOS"), "AGE", F.round("weight", 9).alias("weight"))


@query
def stays_mimiciv(spark, d):
    return shown(load_stays(source_of(spark, "mimiciv", anchored_frames(spark, d, "hosp", "icu", "226512"))), "hadm_id", "patient_id")


@query
def stays_nwicu(spark, d):
    return shown(load_stays(source_of(spark, "nwicu", anchored_frames(spark, d, "nw_hosp", "nw_icu", "326531"))), "hadm_id", "patient_id")


@query
def stays_eicu(spark, d):
    patient = table(spark, d, "orders").selectExpr(
        "o_orderkey AS patientunitstayid", "o_orderkey % 1000 AS patienthealthsystemstayid", "o_custkey AS uniquepid",
        "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '> 89' ELSE cast(o_orderkey % 60 + 20 AS string) END AS age",
        "-(o_orderkey % 500 + 1) AS hospitaladmitoffset", "o_orderkey % 9000 AS hospitaldischargeoffset",
        "CASE WHEN o_orderstatus = 'F' THEN 'Expired' ELSE 'Alive' END AS hospitaldischargestatus",
        "o_orderkey % 8000 AS unitdischargeoffset", "CASE o_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END AS gender",
        "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 90 END AS admissionweight", "1 AS unitvisitnumber",
    )
    return shown(load_stays(source_of(spark, "eicu", {"patient": patient})), "hadm_id", "patient_id")


@query
def stays_umcdb(spark, d):
    admissions = table(spark, d, "orders").selectExpr(
        "o_orderkey AS admissionid", "o_custkey AS patientid", "(o_orderkey % 500) * 60000 AS admittedat",
        "(o_orderkey % 9000) * 60000 AS dischargedat", "CASE WHEN o_orderstatus = 'F' THEN 'Overleden' ELSE 'Huis' END AS destination",
        "o_orderkey % 300 AS lengthofstay", "CASE o_custkey % 3 WHEN 0 THEN 'Man' WHEN 1 THEN 'Frouw' END AS gender",
        "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 90 END AS weight", "1 AS admissioncount",
    )
    return shown(load_stays(source_of(spark, "umcdb", {"admissions": admissions})), "patient_id")


@query
def stays_hirid(spark, d):
    """Length of stay up to the last event of any table, median weight, flag of death."""
    frames = {
        "general_table": table(spark, d, "orders").selectExpr(
            "o_orderkey AS patientid", f"{CLOCK.format('o_orderdate')} AS admissiontime", "o_orderkey % 60 + 20 AS age",
            "CASE WHEN o_orderstatus = 'F' THEN 'dead' ELSE 'alive' END AS discharge_status",
        ),
        "observation_tables/csv": table(spark, d, "lineitem").where("l_orderkey % 10 <> 0").selectExpr(
            "l_orderkey AS patientid", "CASE WHEN l_linenumber % 2 = 0 THEN '10000400' ELSE '1' END AS variableid",
            "l_quantity + 40 AS value", f"{CLOCK.format('l_shipdate')} AS datetime",
        ),
        "pharma_records/csv": table(spark, d, "orders").where("o_orderkey % 4 = 0").selectExpr(
            "o_orderkey AS patientid", f"{CLOCK.format('o_orderdate + make_dt_interval(o_orderkey % 90)')} AS givenat",
        ),
    }
    return shown(load_stays(source_of(spark, "hirid", frames)))


@query
def stays_sicdb(spark, d):
    """In-unit blocks from a unit log for a third of the cases, the time of stay for the others; weights in grams and missing ones."""
    cases = table(spark, d, "orders").selectExpr(
        "o_orderkey AS CaseID", "o_custkey AS PatientID", "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 7 * 3600 END AS ICUOffset",
        "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 11 * 7200 END AS TimeOfStay",
        "CASE WHEN o_orderstatus = 'F' THEN '2028' ELSE '1' END AS HospitalDischargeType",
        "CASE WHEN o_orderkey % 13 = 0 THEN '2215' ELSE '0' END AS DischargeState",
        "CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 900 * 60 + 30 END AS OffsetOfDeath", "o_orderkey % 100 AS AgeOnAdmission",
        "CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN (o_orderkey % 90 + 30) * 1000 ELSE o_orderkey % 90 + 30 END AS WeightOnAdmission",
    )
    root = scratch_path(spark, "sicdb")
    log = table(spark, d, "lineitem").where("l_orderkey % 3 = 0")
    log = log.selectExpr("l_orderkey AS CaseID", "l_linenumber * 3600 AS Offset", "l_partkey % 5 AS HospitalUnit")
    log.write.option("header", True).csv(f"{root}/unitlog.csv")
    units = table(spark, d, "region").selectExpr(
        "r_regionkey AS ReferenceGlobalID", "CASE WHEN r_regionkey < 2 THEN 'INIC' ELSE r_name END AS ReferenceValue", "'HospitalUnit' AS ReferenceName"
    )
    units.write.option("header", True).csv(f"{root}/d_references.csv")
    text = cases.select([F.col(c).cast("string").alias(c) for c in cases.columns])
    return shown(load_stays(Source(spark, root, load_profile("sicdb"), frames={"cases": text})), "hadm_id", "patient_id")


@query
def stays_ehrshot(spark, d):
    """Units known by either of two names, dates where times are missing, births from parts, weights in lb and oz."""
    day = "date_format({0}, 'yyyy-MM-dd')"
    orders = table(spark, d, "orders")
    entry, leave = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 50 AS int))", "o_orderdate + make_dt_interval(3, cast(o_orderkey % 20 AS int))"
    frames = {
        "care_site": table(spark, d, "nation").selectExpr(
            "n_nationkey AS care_site_id", "CASE WHEN n_nationkey % 5 = 0 THEN concat(n_name, ' MICU') ELSE n_name END AS care_site_name"
        ),
        "visit_detail": orders.selectExpr(
            "o_orderkey AS visit_detail_id", "o_orderkey AS visit_occurrence_id", "o_custkey AS person_id", "o_custkey % 25 AS care_site_id",
            "CASE o_orderkey % 4 WHEN 0 THEN 'Surgical icu' WHEN 1 THEN NULL ELSE 'Ward' END AS visit_detail_source_value",
            f"CASE WHEN o_orderkey % 7 <> 0 THEN {CLOCK.format(entry)} END AS visit_detail_start_DATETIME",
            f"{day.format('o_orderdate')} AS visit_detail_start_DATE",
            f"CASE WHEN o_orderkey % 9 <> 0 THEN {CLOCK.format(leave)} END AS visit_detail_end_DATETIME",
            f"{day.format('o_orderdate + make_dt_interval(4)')} AS visit_detail_end_DATE",
        ),
        "visit_occurrence": orders.selectExpr(
            "o_orderkey AS visit_occurrence_id", f"{day.format('o_orderdate')} AS visit_start_DATE",
            f"CASE WHEN o_orderkey % 5 <> 0 THEN {CLOCK.format('o_orderdate')} END AS visit_start_DATETIME",
        ),
        "person": table(spark, d, "customer").selectExpr(
            "c_custkey AS person_id", "CASE c_custkey % 3 WHEN 0 THEN 8507 WHEN 1 THEN 8532 END AS gender_concept_id",
            "CASE WHEN c_custkey % 2 = 0 THEN '1950-06-15 00:00:00' END AS birth_DATETIME", "c_nationkey + 1940 AS year_of_birth",
            "CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey % 12 + 1 END AS month_of_birth", "CASE WHEN c_custkey % 7 <> 0 THEN 15 END AS day_of_birth",
        ),
        "measurement": table(spark, d, "lineitem").selectExpr(
            "l_orderkey AS visit_detail_id", "CASE WHEN l_linenumber % 2 = 0 THEN '3025315' ELSE '1' END AS measurement_concept_id",
            "l_quantity + 40 AS value_as_number", "CASE l_linenumber WHEN 6 THEN 8739 WHEN 4 THEN 9373 ELSE 9529 END AS unit_concept_id",
        ),
    }
    root = scratch_path(spark, "ehrshot")
    deaths = table(spark, d, "customer").where("c_custkey % 11 = 0").selectExpr(
        "c_custkey AS person_id", "'1999-01-01' AS death_DATE", "CASE WHEN c_custkey % 2 = 0 THEN '1999-01-02 03:04:05' END AS death_DATETIME"
    )
    deaths.write.option("header", True).csv(f"{root}/death.csv")
    text = {f: df.select([F.col(c).cast("string").alias(c) for c in df.columns]) for f, df in frames.items()}
    found = shown(load_stays(Source(spark, root, load_profile("ehrshot"), frames=text)), "hadm_id", "patient_id")
    return found.withColumn("weight", F.round("weight", 6))


RULES = {
    "listed": {"code": "itemid", "codes": ("3", "17")},
    "present": {"code": "itemid", "codes": ("3", "17"), "value": "value"},
    "equals": {"value": "value", "equals": "-4.0"},
    "number": {"code": "itemid", "codes": ("5", "6", "7"), "value": "value", "equals": "1.0"},
    "positive": {"code": "itemid", "codes": ("8", "9"), "value": "value"},
    "nonzero": {"value": "value"},
    "keyword": {"code": "name", "codes": ("economy", "plated")},
}


@query
def exclusion_rules(spark, d):
    """Which rows each kind of exclusion rule counts."""
    kinds = table(spark, d, "part").selectExpr("p_partkey", "p_type AS name")
    raw = table(spark, d, "lineitem").join(kinds, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_partkey % 40 AS string) AS itemid", "name",
        "CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'In use' ELSE cast(l_quantity - 25 AS string) END AS value",
    )
    counted = {
        f"is_{rule}": F.coalesce(clinical.counts(Exclusion("", "stay", "", "abs", rule, **spec), raw), F.lit(False)) for rule, spec in RULES.items()
    }
    return raw.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in counted.items()])


def anchored_sql(same_unit: bool, ounce: str) -> str:
    return f"""WITH w AS (
  SELECT l_orderkey AS k, avg({ounce}) AS w FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL),
s AS (
  SELECT *, date_trunc('second', o_orderdate) AS a, date_trunc('second', o_orderdate + to_hours(o_orderkey % 100)) AS i
  FROM orders {'WHERE o_orderkey % 5 <> 0' if same_unit else ''})
SELECT o_orderkey * 10 AS stay_id, o_orderkey AS hadm_id, CAST(o_custkey AS VARCHAR) AS patient_id,
  CAST(floor(date_diff('second', a, i) / 60) AS DOUBLE) AS "INTIME",
  CASE WHEN o_orderstatus = 'F' THEN 14400.0::DOUBLE END AS "DEATHTIME", CAST(o_orderkey % 9 AS DOUBLE) AS "LOS",
  CAST(year(i) - 1980 + c_nationkey + 20 AS DOUBLE) AS "AGE",
  round(CAST(coalesce(w, CASE c_nationkey % 3 WHEN 0 THEN 80.0 WHEN 1 THEN 65.0 END, 72.5) AS DOUBLE), 9) AS weight
FROM s LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN w ON k = o_orderkey"""


DEFAULT_WEIGHT = "CASE o_custkey % 3 WHEN 0 THEN 80.0 WHEN 1 THEN 65.0 ELSE 72.5 END"
WEIGHT = f"""CASE WHEN o_orderkey % 4 = 0 THEN {DEFAULT_WEIGHT} WHEN o_orderkey % 90 = 0 THEN 72.5 ELSE o_orderkey % 90 END"""
ORACLES = {
    "stays_mimiciv": anchored_sql(True, "l_quantity + 40"),
    "stays_nwicu": anchored_sql(False, "CASE WHEN l_linenumber = 4 THEN (l_quantity + 40) * 0.0283495 ELSE l_quantity + 40 END"),
    "stays_eicu": f"""SELECT o_orderkey AS stay_id, o_orderkey % 1000 AS hadm_id, CAST(o_custkey AS VARCHAR) AS patient_id,
  CAST(o_orderkey % 500 + 1 AS DOUBLE) AS "INTIME",
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 9000 + o_orderkey % 500 + 1 AS DOUBLE) END AS "DEATHTIME",
  round((o_orderkey % 8000) / 60 / 24, 6) AS "LOS", CAST(CASE o_orderkey % 7 WHEN 1 THEN 300 ELSE o_orderkey % 60 + 20 END AS DOUBLE) AS "AGE",
  CAST({WEIGHT} AS DOUBLE) AS weight FROM orders WHERE o_orderkey % 7 <> 0""",
    "stays_hirid": """WITH seen AS (
  SELECT l_orderkey AS k, date_trunc('second', l_shipdate) AS t FROM lineitem WHERE l_orderkey % 10 <> 0
  UNION ALL SELECT o_orderkey, date_trunc('second', o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER))) FROM orders WHERE o_orderkey % 4 = 0),
latest AS (SELECT k, max(t) AS t FROM seen GROUP BY k),
w AS (SELECT l_orderkey AS k, quantile_disc(l_quantity + 40, 0.5) AS w FROM lineitem WHERE l_orderkey % 10 <> 0 AND l_linenumber % 2 = 0 GROUP BY ALL)
SELECT o_orderkey AS stay_id, 0.0::DOUBLE AS "INTIME", CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE END AS "DEATHTIME",
  round(CAST(date_diff('second', date_trunc('second', o_orderdate), latest.t) AS DOUBLE) / 86400, 6) AS "LOS",
  CAST(o_orderkey % 60 + 20 AS DOUBLE) AS "AGE", round(CAST(coalesce(w, 75.0) AS DOUBLE), 9) AS weight
FROM orders JOIN latest ON latest.k = o_orderkey LEFT JOIN w ON w.k = o_orderkey""",
    "stays_sicdb": """WITH log AS (
  SELECT l_orderkey AS k, l_linenumber * 3600 AS t, l_partkey % 5 < 2 AS inside FROM lineitem WHERE l_orderkey % 3 = 0),
entry AS (SELECT k, min(t) AS block_in FROM log WHERE inside GROUP BY k),
leave AS (SELECT k, min(t) AS block_out FROM log JOIN entry USING (k) WHERE NOT inside AND t >= block_in GROUP BY k),
c AS (
  SELECT o_orderkey AS k, o_custkey, coalesce(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 11 * 7200 END, 0) AS seconds,
    coalesce(block_in, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 7 * 3600 END, 0) AS start, block_out,
    o_orderstatus = 'F' OR o_orderkey % 13 = 0 AS died, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 900 * 60 + 30 END AS death,
    CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE o_orderkey % 90 + 30 END AS w
  FROM orders LEFT JOIN entry e ON e.k = o_orderkey LEFT JOIN leave l ON l.k = o_orderkey),
s AS (SELECT *, coalesce(block_out, start + seconds) AS stop FROM c WHERE coalesce(block_out, start + seconds) > start),
m AS (SELECT coalesce(median(w), 72.5) AS m FROM s)
SELECT k AS stay_id, k AS hadm_id, CAST(o_custkey AS VARCHAR) AS patient_id, CAST(start / 60 AS DOUBLE) AS "INTIME",
  coalesce(CAST(death AS DOUBLE) / 60, CASE WHEN died THEN CAST(seconds AS DOUBLE) / 60 END) AS "DEATHTIME",
  round(CAST(stop - start AS DOUBLE) / 86400, 6) AS "LOS", CAST(least(k % 100, 90) AS DOUBLE) AS "AGE",
  round(CAST(CASE WHEN coalesce(w, m) <= 0 THEN m ELSE coalesce(w, m) END AS DOUBLE), 9) AS weight FROM s, m""",
    "stays_ehrshot": """WITH w AS (
  SELECT l_orderkey AS k, avg(CASE l_linenumber WHEN 6 THEN (l_quantity + 40) * 0.45359237 WHEN 4 THEN (l_quantity + 40) * 0.0283495231 ELSE l_quantity + 40 END) AS w
  FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL),
p AS (
  SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '1950-06-15' ELSE CAST(make_date(c_nationkey + 1940,
      CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey % 12 + 1 ELSE 1 END, CASE WHEN c_custkey % 7 <> 0 THEN 15 ELSE 1 END) AS TIMESTAMP) END AS born,
    CASE WHEN c_custkey % 11 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '1999-01-02 03:04:05' ELSE TIMESTAMP '1999-01-01' END END AS died
  FROM customer),
s AS (
  SELECT o_orderkey AS k, o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN date_trunc('second', o_orderdate) ELSE date_trunc('day', o_orderdate) END AS a,
    CASE WHEN o_orderkey % 7 <> 0 THEN date_trunc('second', o_orderdate + to_hours(o_orderkey % 50)) ELSE date_trunc('day', o_orderdate) END AS i,
    CASE WHEN o_orderkey % 9 <> 0 THEN date_trunc('second', o_orderdate + to_days(3) + to_hours(o_orderkey % 20))
         ELSE date_trunc('day', o_orderdate + to_days(4)) END AS o
  FROM orders WHERE o_orderkey % 4 = 0 OR o_custkey % 25 IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 5 = 0))
SELECT k AS stay_id, k AS hadm_id, CAST(o_custkey AS VARCHAR) AS patient_id,
  CAST(floor((epoch_us(i) - epoch_us(a)) / 60000000) AS DOUBLE) AS "INTIME", CAST(floor((epoch_us(died) - epoch_us(a)) / 60000000) AS DOUBLE) AS "DEATHTIME",
  round(CAST(date_diff('second', i, o) AS DOUBLE) / 86400, 6) AS "LOS", floor(date_diff('second', born, i) / 86400) / 365.25 AS "AGE",
  round(CAST(coalesce(w, CASE o_custkey % 3 WHEN 0 THEN 80.0 WHEN 1 THEN 65.0 END, 72.5) AS DOUBLE), 6) AS weight
FROM s LEFT JOIN p ON c_custkey = o_custkey LEFT JOIN w USING (k)""",
    "exclusion_rules": """WITH raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey % 40 AS itemid, lower(p_type) AS name,
    CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'In use' ELSE CAST(l_quantity - 25 AS VARCHAR) END AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey), typed AS (SELECT *, try_cast(value AS DOUBLE) AS v FROM raw)
SELECT l_orderkey, l_linenumber, itemid IN (3, 17) AS is_listed, itemid IN (3, 17) AND value IS NOT NULL AS is_present,
  coalesce(value = '-4.0', false) AS is_equals, coalesce(itemid IN (5, 6, 7) AND v = 1, false) AS is_number,
  coalesce(itemid IN (8, 9) AND v > 0, false) AS is_positive, coalesce(v <> 0, false) AS is_nonzero,
  name LIKE '%economy%' OR name LIKE '%plated%' AS is_keyword FROM typed""",
    "stays_umcdb": f"""SELECT o_orderkey AS stay_id, CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderkey % 500 AS DOUBLE) AS "INTIME",
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 9000 AS DOUBLE) END AS "DEATHTIME",
  round((o_orderkey % 300) / 24, 6) AS "LOS", CAST(100 AS DOUBLE) AS "AGE", CAST({WEIGHT} AS DOUBLE) AS weight FROM orders""",
}
