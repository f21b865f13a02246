"""Labels that need only the cohort, and operations on label columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.timeframe import DAY_MINUTES

# Cohort columns that are no labels.
COHORT_COLUMNS = (
    "stay_id", "hadm_id", "patient_id", "INTIME", "ADMITTIME", "DEATHTIME", "LOS", "AGE", "weight",
)
MISSING = -1


def los_labels(cohort: DataFrame, days: list[int]) -> DataFrame:
    return cohort.withColumns({f"los_{d}": (F.col("LOS") > d).cast("int") for d in days})


def mortality_labels(cohort: DataFrame, days: list[int], pred_hours: int) -> DataFrame:
    """Death within ``days`` days after the prediction point (earlier deaths count too)."""
    since_entry = F.col("DEATHTIME") - F.col("INTIME")
    return cohort.withColumns(
        {
            f"mortality_{d}": F.coalesce(since_entry < pred_hours * 60 + d * DAY_MINUTES, F.lit(False)).cast("int")
            for d in days
        }
    )


def in_unit_mortality(cohort: DataFrame) -> DataFrame:
    died = F.col("DEATHTIME") - F.col("INTIME") < F.col("LOS") * DAY_MINUTES
    return cohort.withColumn("in_icu_mortality", F.coalesce(died, F.lit(False)).cast("int"))


def label_columns(df: DataFrame, extra: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c not in COHORT_COLUMNS and c not in extra]


def numeric_labels(df: DataFrame) -> list[str]:
    kinds = dict(df.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c in label_columns(df) if kinds[c] in numeric]


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna(MISSING, subset=numeric_labels(df))


def label_stats(df: DataFrame, tasks: list[str] | None = None) -> DataFrame:
    """Rows per (task, label), long form."""
    tasks = tasks or numeric_labels(df)
    long = df.select(*[F.col(t).cast("bigint").alias(t) for t in tasks]).unpivot(
        [], tasks, "task", "label"
    )
    return (
        long.groupBy("task", F.coalesce("label", F.lit(MISSING).cast("bigint")).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_stats_wide(stats: DataFrame, labels: list[int]) -> DataFrame:
    """One row per task, one column per label, missing counts 0."""
    return stats.groupBy("task").pivot("label", labels).agg(F.sum("n")).fillna(0)
