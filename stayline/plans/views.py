"""Stays, measurements and other clinical shapes derived from the general test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.values import Bands
from stayline.operators.labs import LabRules

EXCLUSION_ABOVE = 150
CUTS = (15, 35, 70, 110)
UP, DOWN = (0, 1, 2, 3, 4), (4, 3, 2, 1, 0)
EVENT_MEASURES = {
    "creatinine": ["error"],
    "platelets": ["click"],
    "wbc": ["view"],
    "hb": ["signup"],
    "urine": ["purchase"],
}
URINE_CUTS = (0.2, 0.5, 1.0, 1.5)
TASKS = ["creatinine", "platelets", "wbc", "hb", "urine", "AKI"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bands(closed: str) -> dict[str, Bands]:
    return {
        "creatinine": Bands.of(CUTS, UP, closed),
        "platelets": Bands.of(CUTS, DOWN, closed),
        "wbc": Bands.of(CUTS, UP, closed),
        "hb": Bands.of(CUTS, UP, closed),
        "urine": Bands.of(URINE_CUTS, DOWN, closed),
    }


def rules(**changes) -> LabRules:
    return LabRules(**{"bands": event_bands(changes.get("closed", "left")), **changes})


def stays(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """One stay per user (as admission) and block of days of the month, from its events."""
    blocks = (
        table(spark, sf_dir, "events")
        .selectExpr("user_id AS hadm_id", f"floor((day(ts) - 1) / {days}) AS block", "ts")
        .groupBy("hadm_id", "block")
        .agg(F.min("ts").alias("in_ts"), F.max("ts").alias("out_ts"))
    )
    # a user has at most 31 / days + 1 blocks
    admitted = blocks.groupBy("hadm_id").agg(F.min("in_ts").alias("ADMITTIME"))
    micros = "unix_micros(CAST({0} AS TIMESTAMP))"
    entry = f"({micros.format('in_ts')} - {micros.format('ADMITTIME')})"
    inside = f"({micros.format('out_ts')} - {micros.format('in_ts')})"
    return blocks.join(admitted, "hadm_id").selectExpr(
        "hadm_id * 100 + block AS stay_id",
        "hadm_id",
        "pmod(hadm_id, 50) AS patient_id",
        "ADMITTIME",
        "unix_timestamp(ADMITTIME) AS admit_s",
        "in_ts",
        f"CAST(floor({entry} / 60000000) AS DOUBLE) AS INTIME",
        f"{inside} / 86400000000 AS LOS",
        "pmod(hadm_id, 70) + 15 AS AGE",
        "CAST(pmod(hadm_id, 60) + 40 AS DOUBLE) AS weight",
    )


def own_block(days: int) -> Column:
    """Stay id of the block an event lies in."""
    return F.col("user_id") * 100 + F.floor((F.day("ts") - 1) / days)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS hadm_id", "event_id", "event_type AS code", "unix_timestamp(ts) AS clock_s", "value"
    )


def exclusion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(spark, sf_dir).where(f"code = 'error' AND value > {EXCLUSION_ABOVE}")


def joined(array: Column, separator: str = " ") -> Column:
    return F.array_join(array.cast("array<string>"), separator)


def joined_numbers(array: Column) -> Column:
    """Whole numbers, none of them null, as ``joined`` gives them, without a text for each of them."""
    return F.replace(F.btrim(F.to_json(array), F.lit("[]")), F.lit(","), F.lit(" "))
