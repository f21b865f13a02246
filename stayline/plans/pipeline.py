"""The jobs a user runs on a source: cohort, labels, event sequences, text profile."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.timeframe import as_double, as_timestamp, epoch_seconds
from stayline.functions.tokens import column
from stayline.operators import cohort as cohorts
from stayline.operators import encode, events, labels, labs, language, words
from stayline.session import configure
from stayline.sources import clinical, writers
from stayline.sources.profile import EventTable, Source
from stayline.sources.readers import sampled
from stayline.sources.stays import load_stays

LAB_TASKS = ("creatinine", "platelets", "wbc", "hb", "bicarbonate", "sodium", "urine", "AKI")


@dataclass(frozen=True)
class Config:
    obs_hours: int = 48
    pred_hours: int = 48
    min_age: float | None = 18
    max_age: float | None = None
    mortality: tuple[int, ...] = (1, 2, 3, 7, 14)
    los: tuple[int, ...] = (7, 14)
    in_icu_mortality: bool = False
    readmission: bool = False
    diagnosis: bool = False
    lab_tasks: tuple[str, ...] = LAB_TASKS
    horizons: tuple[int, ...] = (1, 2, 3)
    max_events: int = 256
    min_events: int | None = None
    max_tokens: int = 128
    vocabulary: int | None = None
    more_tables: bool = False
    visits: bool = False
    sample: float | None = None

    def __post_init__(self):
        if self.min_age is not None and self.max_age is not None and self.min_age > self.max_age:
            raise ValueError("min_age is above max_age")
        if self.min_events is not None and self.min_events > self.max_events:
            raise ValueError("min_events is above max_events")
        if self.diagnosis and not self.lab_tasks and not self.los:
            raise ValueError("no task left")


def build_cohort(source: Source, config: Config) -> DataFrame:
    stays = load_stays(source)
    if config.sample is not None:
        stays = sampled(stays, config.sample, "stay_id")
    kept = cohorts.build_cohort(stays, config.obs_hours, config.min_age, config.max_age)
    if config.readmission and "hadm_id" in kept.columns:
        kept = cohorts.flag_readmission(kept, "hadm_id", "stay_order")
    return kept


def build_labels(source: Source, cohort: DataFrame, config: Config, fill: bool = True) -> DataFrame:
    """Cohort with all labels, missing ones -1."""
    labelled = cohort
    times_known = source.profile.name != "hirid"  # only a death flag and derived stays there
    if config.los and times_known:
        labelled = labels.los_labels(labelled, list(config.los))
    if config.mortality and times_known:
        labelled = labels.mortality_labels(labelled, list(config.mortality), config.pred_hours)
    if config.in_icu_mortality:
        labelled = labels.in_unit_mortality(labelled)
    if config.diagnosis and source.profile.name in clinical.DIAGNOSES:
        labelled = clinical.diagnosis_sets(source, labelled)
    tasks = [t for t in config.lab_tasks if t not in source.profile.constant_labels]
    if tasks:
        marked = clinical.with_exclusion(source, labelled)
        rules = source.profile.rules(config.pred_hours, config.horizons)
        measured = clinical.measurements(source, cohort)
        codes = {t: [t] for t in tasks if t != "AKI"} | {"creatinine": ["creatinine"]}
        labelled = labs.lab_labels(measured, marked, source.profile.join, rules, tasks, codes)
    for task in source.profile.constant_labels:
        if task in config.lab_tasks:
            labelled = labelled.withColumns({f"{task}_{h}": F.lit(labels.MISSING) for h in config.horizons})
    helpers = ("admit_s", "stay_order", "exclusion_s", "excluded")
    labelled = labelled.drop(*helpers)
    return labels.fill_missing(labelled) if fill else labelled


def read_events(source: Source, table: EventTable, enriched: bool = True) -> tuple[DataFrame, list[str]]:
    """An event table without excluded columns and with described codes; names of its code columns."""
    raw = source.keyed(table.file, patient=False)
    if table.group == "ed":
        raw = _through_visits(source, table)
    if "stay_id" not in raw.columns and "hadm_id" not in raw.columns:
        raise ValueError(f"{table.file} has neither a stay nor an admission key")
    rows = raw.drop(*table.exclude)
    codes = []
    if enriched:
        for lookup in table.codes:
            rows = events.attach_dictionary(
                rows, source.table(lookup.file), lookup.column, lookup.key, lookup.describe, lookup.only
            )
            codes.append(f"original_code_{lookup.column}")
    return rows, codes


def _through_visits(source: Source, table: EventTable) -> DataFrame:
    """Events of emergency visits, moved to the admission the visit led to."""
    visits = source.profile.visits
    own = source.table(table.file)
    led_to = source.table(visits["file"]).withColumnRenamed(source.profile.keys["hadm"], "hadm_id")
    times = {"ED_INTIME": "intime", "ED_OUTTIME": "outtime"}
    wanted = {times[table.time]: table.time} if table.time in times else {}
    joined = events.attach_visit(own, led_to, visits["key"], {"hadm_id": "hadm_id", **wanted})
    return joined.drop(visits["key"]).withColumn("hadm_id", F.col("hadm_id").try_cast("bigint"))


def align_table(source: Source, cohort: DataFrame, table: EventTable, config: Config) -> tuple[DataFrame, list[str], list[str]]:
    """The events of a table that can still be among the latest of their stay, with ``TIME``.

    Returns them with their data columns and code columns.  Per stay and table only the latest
    ``max_events`` are kept, before any text work.  ``tie`` orders events of the same minute by
    content.
    """
    rows, codes = read_events(source, table)
    columns = [c for c in rows.columns if c not in ("stay_id", "hadm_id", table.time)]
    rows = rows.withColumn("tie", F.xxhash64(F.lit(table.label), *[column(c) for c in columns]))
    at = F.col(table.time)
    if source.profile.join == "hadm_id" and table.unit in ("abs", "min"):
        if table.unit == "abs":
            placed = rows.drop("stay_id").withColumn("clock_s", epoch_seconds(as_timestamp(at)))
        else:
            placed = events.rekey_to_admission(rows.drop("hadm_id"), cohort, table.time).withColumn(
                "clock_s", F.col("minute") * 60
            ).drop("minute")
        kept = events.latest_clock_events(
            placed.drop(table.time), cohort, "hadm_id", config.pred_hours, config.max_events, ["tie"]
        )
    else:
        timed = rows.withColumn(table.time, as_timestamp(at) if table.unit == "abs" else as_double(at))
        aligned = events.align(timed, cohort, table.unit, table.time, config.pred_hours, by_admission=False)
        kept = events.latest_events(aligned, config.max_events, ["tie"])
    return kept, columns, codes


def encode_table(source: Source, cohort: DataFrame, table: EventTable, config: Config) -> DataFrame:
    kept, columns, codes = align_table(source, cohort, table, config)
    return encode.linearise(kept, table.label, columns, codes, config.max_tokens, ("stay_id", "TIME", "tie"))


def encode_events(source: Source, cohort: DataFrame, config: Config) -> DataFrame:
    """Latest events of each stay over all tables (stay_id, TIME, tie, tokens, types, places, original_text, codes)."""
    tables = source.profile.event_tables(config.more_tables, config.visits)
    encoded = events.union_all([encode_table(source, cohort, t, config) for t in tables])
    return events.latest_events(encoded, config.max_events, ["tie"])


def build_sequences(cohort: DataFrame, encoded: DataFrame, config: Config, vocabulary: DataFrame) -> DataFrame:
    """Stay sequences from encoded events."""
    if config.min_events is not None:
        enough = encoded.groupBy("stay_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= config.min_events)
        cohort = cohort.join(enough.select("stay_id"), "stay_id", "left_semi")
    ids = encode.encode_tokens(encoded, vocabulary)
    return encode.stay_sequences(ids, cohort, config.max_events, config.max_tokens, config.pred_hours, ["tie"])


def word_profile(source: Source, config: Config, row_limit: int | None = None) -> DataFrame:
    """Word counts of all text columns of all event tables."""
    found = []
    hidden = {"stay_id", "hadm_id"}
    for table in source.profile.event_tables(config.more_tables, config.visits):
        rows, codes = read_events(source, table)
        rows = rows.limit(row_limit) if row_limit is not None else rows
        columns = words.text_columns(rows, [*hidden, table.time, *codes])
        if columns:
            found.append(words.word_counts(rows, table.label, columns))
    return words.union_counts(found)


def run(source: Source, config: Config, dest: str, reuse: bool = False, verify_only: bool = False) -> DataFrame:
    """Cohort, labels, statistics and sequences of a source, written below ``dest``.

    Every intermediate that is used twice is a written table, so nothing is computed again and
    a lost executor costs only its own tasks.
    """
    spark = configure(source.spark)
    inputs = {n: getattr(source, n, None) for n in ("ext", "classes", "crosswalk")}
    settings = {"source": source.profile.name, "root": source.root, **inputs, **asdict(config)}
    folder = f"{dest}/intermediate"

    def kept(name, build):
        return writers.cached(spark, folder, name, settings, build, reuse, source.inputs())

    cohort = kept("cohort", lambda: build_cohort(source, config))
    labelled = kept("labelled", lambda: build_labels(source, cohort, config))
    tasks = labels.label_columns(labelled)
    writers.write_stats(labels.label_stats(labelled), f"{dest}/label_stats")
    writers.write_labels(labelled, f"{dest}/labels", [t for t in tasks if t != "diagnosis"])
    if verify_only:
        return labelled
    encoded = kept("events", lambda: encode_events(source, cohort, config))
    vocabulary = kept("vocabulary", lambda: encode.build_vocabulary(encoded, config.vocabulary))
    sequences = build_sequences(labelled, encoded, config, vocabulary)
    writers.write_sequences(sequences, f"{dest}/sequences")
    return labelled


def run_language(
    source: Source, config: Config, labelled_text: DataFrame, languages: list[str], dest: str, row_limit: int | None = None
) -> DataFrame:
    """Word counts, word languages and their distribution, written below ``dest``.

    ``labelled_text`` has (text, lang) and trains the language model.
    """
    spark = configure(source.spark)
    writers.write_word_counts(word_profile(source, config, row_limit), f"{dest}/word_counts")
    counts = spark.read.schema("table string, column string, word string, cnt bigint").json(f"{dest}/word_counts")
    train = lambda: language.train(labelled_text, "text", "lang", languages)
    model = writers.cached(spark, f"{dest}/intermediate", "language", {"languages": languages}, train)  # always trained anew
    writers.write_word_languages(language.classify_counts(counts, model, languages), f"{dest}/word_languages")
    classified = spark.read.parquet(f"{dest}/word_languages")
    writers.write_distribution(language.distribution(classified), f"{dest}/language_distribution")
    return classified
