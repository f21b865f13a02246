"""Laboratory labels over daily horizons after the prediction point.

Measurements have the columns ``code``, ``clock_s`` (seconds on the clock of ``ADMITTIME``, see
:mod:`stayline.functions.timeframe`) and ``value`` next to their join key.  The cohort has
``stay_id``, the join key, ``admit_s`` (``ADMITTIME`` on the same clock), ``INTIME`` in minutes
and, where exclusion is used, ``exclusion_s`` on the same clock.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.functions.timeframe import DAY_SECONDS, horizon_of
from stayline.functions.tokens import column, text_literal
from stayline.functions.values import Bands, relative_change, row_max
from stayline.operators.quantiles import group_summary

# Cut points and labels of each task.
CUTS = {
    "platelets": ((20, 50, 100, 150), (4, 3, 2, 1, 0)),
    "creatinine": ((1.2, 2.0, 3.5, 5.0), (0, 1, 2, 3, 4)),
    "wbc": ((4, 12), (0, 1, 2)),
    "hb": ((8, 10, 12), (0, 1, 2, 3)),
    "bicarbonate": ((22, 29), (0, 1, 2)),
    "sodium": ((135, 145), (0, 1, 2)),
    "urine": ((0.05, 0.1, 0.3, 0.5), (4, 3, 2, 1, 0)),
    "AKI": ((0.3, 1.5, 2.0, 3.0), (0, 1, 2, 3, 4)),
}
BASELINE_BACK_MIN = 7 * 1440
BASELINE_AHEAD_MIN = 12 * 60
# uses of a creatinine value besides its horizon
BASELINE_WINDOW = -1
SINCE_ENTRY = 0
# Measures that stop counting at the first exclusion event.
EXCLUDED_MEASURES = ("creatinine", "urine")


def task_bands(task: str, closed: str = "left", scale: float = 1.0) -> Bands:
    """Bands of a task; in the left-closed form the middle wbc band contains both its ends."""
    cuts, labels = CUTS[task]
    sides = ("left", "right") if task == "wbc" and closed == "left" else closed
    return Bands.of(cuts, labels, sides, scale)


@dataclass(frozen=True)
class LabRules:
    """How one source turns measurements into labels."""

    pred_hours: int = 48
    horizons: tuple[int, ...] = (1, 2, 3)
    exact: bool = True
    closed: str = "left"
    scales: dict[str, float] = field(default_factory=dict)
    combine: str | None = "skip"  # AKI with urine: "skip" or "propagate" nulls, None = not at all
    rounding: str = "round"  # minutes: "round", "floor" or "none"
    excluded: tuple[str, ...] = EXCLUDED_MEASURES
    bands: dict[str, Bands] | None = None
    positive_baseline: bool = False

    def horizon_span(self) -> tuple[int, int]:
        """Minutes after entry covered by all horizons."""
        start = self.pred_hours * 60
        return start + (min(self.horizons) - 1) * 1440, start + max(self.horizons) * 1440

    def band(self, task: str) -> Bands:
        if self.bands and task in self.bands:
            return self.bands[task]
        return task_bands(task, self.closed, self.scales.get(task, 1.0))


def measure_of(code: str, codes: dict[str, list]) -> Column:
    """Name of the measure a code column belongs to (codes compared as text), else null."""
    lists = {m: ", ".join(text_literal(str(c)) for c in cs) for m, cs in codes.items() if cs}
    if not lists:
        return F.lit(None).cast("string")
    whens = " ".join(f"WHEN CAST({code} AS STRING) IN ({members}) THEN '{m}'" for m, members in lists.items())
    return F.expr(f"CASE {whens} END")


def tag_measures(events: DataFrame, codes: dict[str, list], code: str = "code") -> DataFrame:
    """Rows of any wanted measure, with its name; one scan serves every task."""
    return (
        events.where(has_code(events, code, [c for own in codes.values() for c in own]))
        .withColumn("measure", measure_of(code, codes))
        .where("measure IS NOT NULL AND value IS NOT NULL")
    )


def has_code(events: DataFrame, code: str, wanted: list) -> Column:
    """Whether the code is one of ``wanted``, compared in the column's own type so that a scan can skip row groups."""
    kind = events.schema[code].dataType
    own = column(code)
    if isinstance(kind, T.IntegralType):
        return own.isin(*sorted({int(c) for c in wanted if str(c).lstrip("-").isdigit()}))
    if isinstance(kind, T.StringType):
        return own.isin(*sorted({str(c) for c in wanted}))
    return own.cast("string").isin(*sorted({str(c) for c in wanted}))


def minute_since_admission(rounding: str = "round") -> Column:
    exact = "(clock_s - admit_s) / 60"
    forms = {"round": f"round({exact})", "floor": f"CAST(floor({exact}) AS DOUBLE)", "none": exact}
    return F.expr(forms[rounding])


def events_in_window(
    events: DataFrame,
    cohort: DataFrame,
    on: str,
    spans: dict[str, tuple[int, int]],
    rounding: str = "round",
) -> DataFrame:
    """Pairs (event, stay) with ``INTIME + start <= minute < INTIME + end``.

    ``spans`` gives (start, end) in minutes per value of the event column ``span``.  Both sides
    meet on (key, span, calendar day): a stay is listed under the few days its window covers, an
    event under its own day.  Events of other days are never paired, and a busy admission is cut
    into days before the join.
    """
    def slots(span: str, start: int, end: int) -> str:
        first = f"floor((admit_s + (INTIME + {start}) * 60 - 60) / {DAY_SECONDS})"
        last = f"floor((admit_s + (INTIME + {end}) * 60 + 60) / {DAY_SECONDS})"
        fields = f"'span', '{span}', '_day', d, '_start', {start}, '_end', {end}"
        return f"transform(sequence({first}, {last}), d -> named_struct({fields}))"

    listing = ", ".join(slots(span, *limits) for span, limits in spans.items())
    stays = cohort.withColumn("_slot", F.expr(f"explode(concat({listing}))")).select(*cohort.columns, "_slot.*")
    return (
        events.withColumn("_day", F.expr(f"floor(clock_s / {DAY_SECONDS})"))
        .join(stays, [on, "span", "_day"])
        .withColumn("minute", minute_since_admission(rounding))
        .where("minute - INTIME >= _start AND minute - INTIME < _end")
        .drop("_day", "_start", "_end")
    )


def before_exclusion(rows: DataFrame, at: str = "clock_s", first: str = "exclusion_s") -> DataFrame:
    """Rows strictly before the first exclusion event, or without any."""
    return rows.where(F.col(first).isNull() | (F.col(first) > F.col(at)))


def first_exclusion(events: DataFrame, key: str, at: str = "clock_s") -> DataFrame:
    """Earliest exclusion per key."""
    return events.groupBy(key).agg(F.min(at).alias("exclusion_s"))


def multi_stay_excluded(
    stays: DataFrame,
    excluded: DataFrame,
    patient: str = "patient_id",
    count_column: str | None = None,
) -> DataFrame:
    """Patients with more than one stay row and any exclusion event.

    ``count_column`` counts distinct values of that column (for example admissions) instead.
    """
    counting = F.countDistinct(count_column) if count_column else F.count(F.lit(1))
    several = stays.groupBy(patient).agg(counting.alias("_n")).where("_n > 1").select(patient)
    return several.join(excluded.select(patient), patient, "left_semi")


def drop_patients(rows: DataFrame, patients: DataFrame, patient: str = "patient_id") -> DataFrame:
    return rows.join(patients, patient, "left_anti")


def horizon_medians(
    events: DataFrame, cohort: DataFrame, on: str, rules: LabRules
) -> DataFrame:
    """Median ``value`` per (stay, measure, horizon)."""
    spans = {"all": rules.horizon_span()}
    pairs = events_in_window(events.withColumn("span", F.lit("all")), cohort, on, spans, rules.rounding)
    placed = before_if_present(pairs).withColumn(
        "horizon", horizon_of(F.col("minute"), F.col("INTIME"), rules.pred_hours)
    )
    placed = placed.where(F.col("horizon").isin(*rules.horizons))
    keys = ["stay_id", "measure", "horizon"]
    summary = group_summary(placed, keys, "value", exact=rules.exact)
    return summary.select(*keys, F.col("median").alias("value"))


def window_minimum(events: DataFrame, cohort: DataFrame, on: str, rounding: str = "round") -> DataFrame:
    """Smallest value from 7 days before to 12 hours after entry."""
    spans = {"base": (-BASELINE_BACK_MIN, BASELINE_AHEAD_MIN)}
    pairs = events_in_window(events.withColumn("span", F.lit("base")), cohort, on, spans, rounding)
    return before_if_present(pairs).groupBy("stay_id").agg(F.min("value").alias("window_min"))


def before_if_present(pairs: DataFrame) -> DataFrame:
    return before_exclusion(pairs) if "exclusion_s" in pairs.columns else pairs


def first_since_entry(events: DataFrame, cohort: DataFrame, on: str, rounding: str = "round") -> DataFrame:
    """First value at or after entry, however late, without pairing all events with all stays.

    Near the entry (its calendar day and the days next to it) single events are compared.  For
    later days one row per (key, day), its first event, is enough, so a stay meets at most as
    many rows as there are days.
    """
    entry_day = F.floor((F.col("admit_s") + F.col("INTIME") * 60) / DAY_SECONDS)
    stays = cohort.withColumn("_entry_day", entry_day)
    dated = events.withColumn("_day", F.floor(F.col("clock_s") / DAY_SECONDS))
    moment = F.struct("clock_s", "value")

    near = (
        dated.join(
            stays.withColumn("_day", F.explode(F.sequence(F.col("_entry_day") - 1, F.col("_entry_day") + 1))),
            [on, "_day"],
        )
        .withColumn("minute", minute_since_admission(rounding))
        .where(F.col("minute") >= F.col("INTIME"))
    )
    first_of_day = dated.groupBy(on, "_day").agg(F.min(moment).alias("_first"))
    later = (
        first_of_day.select(on, "_day", "_first.clock_s", "_first.value")
        .join(stays, on)
        .where(F.col("_day") > F.col("_entry_day") + 1)
    )
    columns = ["stay_id", "clock_s", "value"] + (["exclusion_s"] if "exclusion_s" in cohort.columns else [])
    found = before_if_present(near.select(*columns).unionByName(later.select(*columns)))
    return found.groupBy("stay_id").agg(F.min(moment)["value"].alias("first_value"))


def baseline(events: DataFrame, cohort: DataFrame, on: str, rounding: str = "round") -> DataFrame:
    """Window minimum, else the first value since entry."""
    low = window_minimum(events, cohort, on, rounding).withColumnRenamed("window_min", "_value")
    first = first_since_entry(events, cohort, on, rounding).withColumnRenamed("first_value", "_value")
    ranked = low.withColumn("_rank", F.lit(0)).unionByName(first.withColumn("_rank", F.lit(1)))
    return ranked.groupBy("stay_id").agg(F.min_by("_value", "_rank").alias("baseline"))


def band_by_measure(values: DataFrame, rules: LabRules, measures: list[str], out: str = "label") -> DataFrame:
    """Label of ``value`` by the bands of its measure."""
    whens = " ".join(f"WHEN '{m}' THEN {rules.band(m).label_sql('value')}" for m in measures)
    return values.withColumn(out, F.expr(f"CASE measure {whens} END"))


def lab_labels(
    events: DataFrame,
    cohort: DataFrame,
    on: str,
    rules: LabRules,
    tasks: list[str],
    codes: dict[str, list],
) -> DataFrame:
    """All lab labels of all horizons: one scan, one pivot, one join to the cohort.

    ``tasks`` may contain ``AKI``, which is derived from the creatinine medians and their
    baseline, and combined with the urine label of the same horizon as the rules say.
    """
    with_aki = "AKI" in tasks
    measures = sorted({("creatinine" if t == "AKI" else t) for t in tasks})
    tagged = tag_measures(events, {m: codes.get(m, []) for m in measures})
    stay_columns = ["stay_id", on, "admit_s", "INTIME", "weight", "exclusion_s", "excluded"]
    stays = cohort.select(*[c for c in dict.fromkeys(stay_columns) if c in cohort.columns])

    start, end = rules.horizon_span()
    spans = {"horizon": (start, end)}
    span = F.lit("horizon")
    if with_aki:
        # the first value since entry matters only where a horizon has a value, so it lies here too
        spans["base"] = (min(-BASELINE_BACK_MIN, start), max(BASELINE_AHEAD_MIN, end))
        span = F.when(F.col("measure") == "creatinine", "base").otherwise("horizon")
    rows = tagged.select(on, "measure", "clock_s", "value", span.alias("span"))
    pairs = events_in_window(rows, stays, on, spans, rules.rounding)

    limited = "measure IN ({})".format(", ".join(text_literal(m) for m in rules.excluded)) if rules.excluded else "false"
    if "exclusion_s" in stays.columns:
        pairs = pairs.where(f"NOT {limited} OR exclusion_s IS NULL OR exclusion_s > clock_s")
    if "excluded" in stays.columns:
        pairs = pairs.where(f"NOT ({limited} AND coalesce(excluded, false))")

    horizon = horizon_of(F.col("minute"), F.col("INTIME"), rules.pred_hours)
    listed = ", ".join(str(h) for h in rules.horizons)
    uses = [f"CASE WHEN _horizon IN ({listed}) THEN _horizon END"]
    if with_aki:
        since = "minute - INTIME"
        window = f"{since} >= -{BASELINE_BACK_MIN} AND {since} < {BASELINE_AHEAD_MIN}"
        uses += [
            f"CASE WHEN span = 'base' AND {window} THEN {BASELINE_WINDOW} END",
            f"CASE WHEN span = 'base' AND {since} >= 0 THEN {SINCE_ENTRY} END",
        ]
    carry = ["weight"] if "weight" in stays.columns and "urine" in measures else []
    keys = ["stay_id", "measure", "use", *carry]
    used = pairs.withColumn("_horizon", horizon).withColumn(
        "use", F.expr(f"explode(array_compact(array({', '.join(uses)})))")
    )
    values = group_summary(used, keys, "value", at="clock_s", exact=rules.exact)
    per_kg = "CASE WHEN measure = 'urine' AND weight IS NOT NULL THEN try_divide(median, weight) ELSE median END"
    values = values.withColumn("value", F.expr(per_kg if carry else "median"))
    labelled = band_by_measure(values, rules, measures)

    def pick(measure: str, use: int, column: str) -> str:
        return f"max(CASE WHEN measure = '{measure}' AND use = {use} THEN {column} END)"

    wide = [f"{pick(m, h, 'label')} AS {m}_{h}" for m in measures for h in rules.horizons]
    if with_aki:
        base = f"coalesce({pick('creatinine', BASELINE_WINDOW, 'lowest')}, {pick('creatinine', SINCE_ENTRY, 'first')})"
        wide += [f"{base} AS _baseline"]
        wide += [f"{pick('creatinine', h, 'value')} AS _value_{h}" for h in rules.horizons]
    result = labelled.groupBy("stay_id").agg(*[F.expr(w) for w in wide])
    if with_aki:
        base = F.expr("CASE WHEN _baseline > 0 THEN _baseline END" if rules.positive_baseline else "_baseline")
        result = result.withColumns(
            {f"_change_{h}": relative_change(F.col(f"_value_{h}"), base) for h in rules.horizons}
        )
        stages = {}
        for h in rules.horizons:
            stage = rules.band("AKI").label(f"_change_{h}")
            if rules.combine and f"urine_{h}" in result.columns:
                stage = row_max(stage, F.col(f"urine_{h}"), missing=rules.combine)
            stages[f"AKI_{h}"] = stage
        result = result.withColumns(stages)
    labels = [f"{t}_{h}" for t in tasks for h in rules.horizons]
    return cohort.join(result.select("stay_id", *labels), "stay_id", "left")
