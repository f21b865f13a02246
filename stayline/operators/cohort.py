"""Stay-level cohort: filters, readmission, length of stay, in-unit blocks, weight."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.quantiles import exact_median


def build_cohort(
    stays: DataFrame, obs_hours: int, min_age: float | None = None, max_age: float | None = None
) -> DataFrame:
    """Stays observed for ``obs_hours`` and within an inclusive age range."""
    kept = stays.where(F.col("LOS") >= obs_hours / 24)
    if min_age is not None:
        kept = kept.where(F.col("AGE") >= min_age)
    if max_age is not None:
        kept = kept.where(F.col("AGE") <= max_age)
    return kept


def flag_readmission(
    cohort: DataFrame, hadm: str = "hadm_id", order: str = "INTIME", stay: str = "stay_id"
) -> DataFrame:
    """0 for the last stay of an admission, 1 for every other stay.

    The last stay is an aggregate (combined before the shuffle), and it is joined back on the
    stay key, which is unique on both sides, so an admission with very many stays is no hot key.
    Among equal entry times the smallest stay id counts as last.
    """
    last = (
        cohort.where(F.col(hadm).isNotNull())
        .groupBy(hadm)
        .agg(
            F.min_by(
                stay, F.struct(F.col(order).isNull(), -F.col(order), F.col(stay))
            ).alias(stay)
        )
        .select(stay, F.lit(0).alias("_last"))
    )
    return (
        cohort.join(last, stay, "left")
        .withColumn("readmission", F.coalesce("_last", F.lit(1)))
        .drop("_last")
    )


def last_event_time(tables: list[tuple[DataFrame, str, str]], stay: str = "stay_id") -> DataFrame:
    """Latest timestamp per stay over (table, stay column, time column) triples."""
    times = [t.select(F.col(k).alias(stay), F.col(ts).alias("last_time")) for t, k, ts in tables]
    return reduce(DataFrame.unionByName, times).groupBy(stay).agg(F.max("last_time").alias("last_time"))


def los_from_events(
    stays: DataFrame,
    tables: list[tuple[DataFrame, str, str]],
    admitted: str = "ADMITTIME",
    stay: str = "stay_id",
) -> DataFrame:
    """LOS in days up to the last event; stays without any event are dropped."""
    last = last_event_time(tables, stay)
    days = (F.unix_micros(F.col("last_time").cast("timestamp"))
            - F.unix_micros(F.col(admitted).cast("timestamp"))) / 86_400_000_000
    return stays.join(last, stay).withColumn("LOS", days)


def first_block(
    log: DataFrame, in_unit: Column, case: str = "CaseID", at: str = "Offset"
) -> DataFrame:
    """First entry into a unit per case and the first entry elsewhere at or after it."""
    marked = log.select(F.col(case), F.col(at).alias("_at"), in_unit.alias("_in"))
    entry = marked.where("_in").groupBy(case).agg(F.min("_at").alias("block_in"))
    leave = (
        marked.where(~F.col("_in"))
        .join(entry, case)
        .where(F.col("_at") >= F.col("block_in"))
        .groupBy(case)
        .agg(F.min("_at").alias("block_out"))
    )
    return entry.join(leave, case, "left")


def mean_per_stay(measured: DataFrame, value: Column, out: str = "weight", stay: str = "stay_id") -> DataFrame:
    return measured.groupBy(stay).agg(F.avg(value).alias(out))


def impute_with_median(df: DataFrame, column: str, default: float) -> DataFrame:
    """Missing or non-positive values replaced by the median of all values."""
    middle = exact_median(df.select(column), [], column)
    fill = F.coalesce(middle.scalar(), F.lit(default))
    present = F.coalesce(F.col(column), fill)
    return df.withColumn(column, F.when(present <= 0, fill).otherwise(present))
