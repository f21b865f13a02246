"""Clocks and durations.

Two units are used throughout: seconds on a *clock* (Unix seconds where a source has absolute
timestamps, seconds since hospital admission where its times are already relative) and minutes
since hospital admission (``ADMITTIME``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MINUTES = 1440
DAY_SECONDS = 86400


def as_double(c: Column) -> Column:
    """Numeric coercion; text that is no number becomes null."""
    return c.try_cast("double")


def as_long(c: Column) -> Column:
    return c.try_cast("bigint")


def as_timestamp(c: Column) -> Column:
    """Timestamp coercion; unreadable text becomes null."""
    return c.try_cast("timestamp")


def epoch_seconds(c: Column) -> Column:
    """Whole Unix seconds of a timestamp (with or without time zone)."""
    return F.unix_timestamp(c)


def epoch_micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end on whole seconds, rounded half up."""
    return F.round((epoch_seconds(end) - epoch_seconds(start)) / 60)


def whole_minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end, floored (also below zero)."""
    return F.floor((epoch_micros(end) - epoch_micros(start)) / 60_000_000)


def offset_minutes(c: Column, unit: str) -> Column:
    """A numeric offset in ms, sec or min as minutes."""
    per_minute = {"ms": 60_000, "sec": 60, "min": 1}
    if unit not in per_minute:
        raise ValueError(f"unknown time unit {unit!r}; use one of {sorted(per_minute)}")
    return c / per_minute[unit]


def age_from_anchor(at: Column, anchor_year: Column, anchor_age: Column) -> Column:
    """Age when only a (year, age) anchor is published."""
    return F.year(at) - anchor_year + anchor_age


def birth_date(exact: Column, year: Column, month: Column, day: Column) -> Column:
    """Birth timestamp, else the date put together from its parts (January, first day)."""
    parts = F.concat_ws(
        "-",
        year.cast("int").cast("string"),
        F.lpad(F.coalesce(month.cast("int"), F.lit(1)).cast("string"), 2, "0"),
        F.lpad(F.coalesce(day.cast("int"), F.lit(1)).cast("string"), 2, "0"),
    )
    return F.coalesce(exact, F.when(year.isNotNull(), parts.try_cast("timestamp")))


def age_from_birth(at: Column, birth: Column) -> Column:
    """Whole days since birth over 365.25."""
    return F.floor((epoch_seconds(at) - epoch_seconds(birth)) / DAY_SECONDS) / 365.25


def horizon_of(minute: Column, intime: Column, pred_hours: int) -> Column:
    """Day number (1, 2, ...) after the prediction point; 0 or less lies before it."""
    return (F.floor((minute - intime - pred_hours * 60) / DAY_MINUTES) + 1).cast("int")
