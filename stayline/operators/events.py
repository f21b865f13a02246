"""Event tables: time alignment to stays, dictionary and emergency-visit lookup, latest events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.timeframe import DAY_SECONDS, epoch_seconds, offset_minutes
from stayline.functions.tokens import column

OFFSET_UNITS = ("min", "ms", "sec")
# rows per group up to which Spark limits a ranking before its shuffle, and parts of a stay above it
GROUP_LIMIT, SALTS = 1000, 16


def align(
    events: DataFrame,
    cohort: DataFrame,
    unit: str,
    at: str,
    pred_hours: int,
    by_admission: bool = True,
) -> DataFrame:
    """Minutes since unit entry (``TIME``) for every event and stay, up to the prediction point.

    * ``abs``: ``at`` is a timestamp.  Events go to every stay of their admission, or to their
      own stay where there is no admission key.
    * ``min``: ``at`` is minutes since entry of the event's own stay; the event is re-keyed to
      its admission and goes to every stay of it.
    * ``ms``, ``sec``: ``at`` is an offset since admission; the event stays with its own stay.

    Events before unit entry are kept with a negative ``TIME``.
    """
    if unit == "abs":
        key = "hadm_id" if by_admission else "stay_id"
        own = events.drop("stay_id") if by_admission else events
        placed = own.join(cohort.select(*dict.fromkeys([key, "stay_id", "INTIME", "ADMITTIME"])), key)
        minute = F.round((epoch_seconds(F.col(at)) - epoch_seconds(F.col("ADMITTIME"))) / 60)
        timed = placed.withColumn("TIME", minute - F.col("INTIME"))
    elif unit == "min":
        timed = (
            rekey_to_admission(events.drop("hadm_id"), cohort, at)
            .join(cohort.select("hadm_id", "stay_id", "INTIME"), "hadm_id")
            .withColumn("TIME", F.col("minute") - F.col("INTIME"))
            .drop("minute")
        )
    elif unit in OFFSET_UNITS:
        timed = events.join(cohort.select("stay_id", "INTIME"), "stay_id").withColumn(
            "TIME", offset_minutes(F.col(at).try_cast("double"), unit) - F.col("INTIME")
        )
    else:
        raise ValueError(f"unknown time unit {unit!r}")
    return timed.where(F.col("TIME") < pred_hours * 60).drop("INTIME", "ADMITTIME")


def rekey_to_admission(events: DataFrame, cohort: DataFrame, at: str) -> DataFrame:
    """Events of a stay as events of its admission, with ``minute`` since admission."""
    offset = F.col(at).try_cast("double").cast("int")
    return (
        events.join(cohort.select("stay_id", "hadm_id", "INTIME"), "stay_id")
        .withColumn("minute", offset + F.col("INTIME"))
        .drop("stay_id", "INTIME")
    )


def attach_dictionary(
    events: DataFrame,
    dictionary: DataFrame,
    code: str,
    dictionary_code: str,
    describe: dict[str, str],
    only: dict[str, str] | None = None,
) -> DataFrame:
    """Replace a code by its description, keeping the code as ``original_code_<code>``.

    ``describe`` maps dictionary columns to output names, ``only`` filters the dictionary.  The
    join has no hint: the dictionary is broadcast while it is small, and a large one is
    shuffled with splitting of hot codes.
    """
    entries = dictionary
    for name, wanted in (only or {}).items():
        entries = entries.where(column(name) == wanted)
    named = {f"_d{i}": out for i, out in enumerate(describe.values())}
    entries = entries.select(
        F.col(dictionary_code).cast("string").alias("_code"),
        *[column(name).alias(slot) for slot, name in zip(named, describe)],
    )
    kept = f"original_code_{code}"
    joined = (
        events.withColumn(kept, F.col(code).cast("string"))
        .drop(code)
        .join(entries, F.col(kept) == F.col("_code"), "left")
        .drop("_code")
    )
    return joined.withColumnsRenamed(named)


def attach_visit(
    events: DataFrame, visits: DataFrame, key: str, columns: dict[str, str]
) -> DataFrame:
    """Left join of a visit table (for example emergency stays) on its key, renaming columns."""
    chosen = visits.select(key, *[F.col(c).alias(out) for c, out in columns.items()])
    return events.join(chosen, key, "left")


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def latest_events(timed: DataFrame, k: int, ties: list[str], stay: str = "stay_id") -> DataFrame:
    """The latest ``k`` events of each stay by ``TIME``.

    Spark limits each map task to ``k`` rows per stay before the shuffle (WindowGroupLimit) up to
    ``GROUP_LIMIT``; above it the latest of each of ``SALTS`` parts of a stay are taken first.  So a
    busy stay does not reach one task whole.
    """
    if k > GROUP_LIMIT:
        part = F.pmod(F.xxhash64("TIME", *ties), F.lit(SALTS))
        own = Window.partitionBy(stay, "_salt").orderBy(F.desc("TIME"), *[F.desc(t) for t in ties])
        timed = timed.withColumn("_salt", part).withColumn("_rank", F.row_number().over(own))
        timed = timed.where(F.col("_rank") <= k).drop("_rank", "_salt")
    newest = Window.partitionBy(stay).orderBy(F.desc("TIME"), *[F.desc(t) for t in ties])
    return timed.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= k).drop("_rank")


def latest_clock_events(
    events: DataFrame, cohort: DataFrame, on: str, pred_hours: int, k: int, ties: list[str]
) -> DataFrame:
    """Same result as aligning on the clock and taking the latest ``k``, on pruned pairs.

    Event counts per (key, day) tell how many days before its prediction point a stay has to
    look back to find ``k`` events; only events of these days are joined to the stay.  An
    admission with many events and many stays is therefore never paired all with all.
    """
    cut_s = F.col("admit_s") + (F.col("INTIME") + pred_hours * 60) * 60
    stays = cohort.select(*dict.fromkeys(["stay_id", on, "INTIME", "admit_s"]))
    dated = events.withColumn("_day", F.floor(F.col("clock_s") / DAY_SECONDS))
    per_day = dated.groupBy(on, "_day").agg(F.count(F.lit(1)).alias("_n"))
    # rounding to minutes may move an event across the cut, so the cut day is followed by a spare
    last_day = F.floor((cut_s + 60) / DAY_SECONDS)
    safe_day = F.floor((cut_s - 60) / DAY_SECONDS)
    newer = Window.partitionBy("stay_id").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    sure = F.when(F.col("_day") < safe_day, F.col("_n")).otherwise(0)
    look_back = (
        stays.join(per_day, on)
        .where(F.col("_day") <= last_day)
        .withColumn("_newer", F.coalesce(F.sum(sure).over(newer), F.lit(0)))
        .where(F.col("_newer") < k)
        .drop("_n", "_newer")
    )
    minute = F.round((F.col("clock_s") - F.col("admit_s")) / 60)
    timed = (
        dated.join(look_back, [on, "_day"])
        .withColumn("TIME", minute - F.col("INTIME"))
        .where(F.col("TIME") < pred_hours * 60)
        .drop("_day", "INTIME", "admit_s")
    )
    return latest_events(timed, k, ties)
