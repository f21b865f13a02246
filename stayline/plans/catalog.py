"""Registered queries: every operator on the general test tables.

Each takes (spark, folder of Parquet tables) and returns a lazy DataFrame over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions import timeframe, values
from stayline.functions.tokens import digit_places, round_decimals, token_list
from stayline.functions.values import row_max
from stayline.operators import cohort as cohorts
from stayline.operators import diagnosis, encode, events, labels, labs, language, quantiles, words
from stayline.plans.views import (
    EVENT_MEASURES, TASKS, event_bands, exclusion_events, joined, joined_numbers,
    measurements, own_block, rules, stays, table,
)
from stayline.session import configure, saved, scratch_path
from stayline.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# ---- cohort -------------------------------------------------------------------------------


@query
def cohort_build(spark, d):
    kept = cohorts.build_cohort(stays(spark, d, 10), 48, 18, 80)
    return kept.select("stay_id", "hadm_id", "INTIME", "LOS", "AGE")


@query
def readmission_flag(spark, d):
    kept = cohorts.build_cohort(stays(spark, d, 3), 24)
    return cohorts.flag_readmission(kept).select("stay_id", "hadm_id", "INTIME", "readmission")


@query
def base_labels(spark, d):
    """Length of stay and mortality; the first large error at or after entry stands for death."""
    cohort = stays(spark, d, 10)
    deaths = exclusion_events(spark, d).select("hadm_id", "clock_s", F.col("clock_s").cast("double").alias("value"))
    died = labs.first_since_entry(deaths, cohort, "hadm_id", "none")
    dated = cohort.join(died, "stay_id", "left").withColumn(
        "DEATHTIME", F.floor((F.col("first_value") - F.col("admit_s")) / 60)
    )
    labelled = labels.los_labels(dated, [3, 7])
    labelled = labels.mortality_labels(labelled, [1, 2, 3, 7, 14], 48)
    labelled = labels.in_unit_mortality(labelled)
    return labelled.select("stay_id", *[c for c in labelled.columns if c.startswith(("los_", "mort", "in_icu"))])


@query
def los_from_events(spark, d):
    orders, seen = table(spark, d, "orders"), table(spark, d, "events")
    admitted = orders.groupBy(F.col("o_custkey").alias("stay_id")).agg(F.min("o_orderdate").alias("ADMITTIME"))
    timed = cohorts.los_from_events(
        admitted, [(seen, "user_id", "ts"), (orders, "o_custkey", "o_orderdate")]
    )
    return timed.select("stay_id", "last_time", "LOS")


@query
def first_block(spark, d):
    log = table(spark, d, "events").select(
        F.col("user_id").alias("CaseID"), F.unix_timestamp("ts").alias("Offset"), "event_type"
    )
    blocks = cohorts.first_block(log, F.col("event_type").isin("view", "click"))
    out = F.coalesce("block_out", F.col("block_in") + 86_400)
    return blocks.withColumn("block_out", out).where(F.col("block_out") > F.col("block_in"))


@query
def stay_weight(spark, d):
    """Mean weight in kg per stay from measurements in three units, imputed by sex."""
    measured = table(spark, d, "events").where(F.col("value") > 100).withColumn("stay_id", own_block(10))
    kg = values.mass_in_kg(
        F.col("value"), F.col("event_type"), {"click": values.KG_PER_LB, "view": values.KG_PER_OZ}
    )
    mean = cohorts.mean_per_stay(measured, kg)
    cohort = stays(spark, d, 10).drop("weight").join(mean, "stay_id", "left")
    sex = F.pmod(F.col("hadm_id"), F.lit(3))
    filled = values.impute_weight(F.col("weight"), sex == 0, sex == 1)
    return cohort.select("stay_id", F.round(filled, 6).alias("weight"))


@query
def weight_median_default(spark, d):
    measured = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("weight")
    )
    filled = cohorts.impute_with_median(measured, "weight", values.WEIGHT_OTHER)
    return filled.select("c_custkey", F.round("weight", 6).alias("weight"))


@query
def normalise_source(spark, d):
    """Stays from orders with patient and admission dimensions: ages, sentinel, dates, left joins."""
    patients = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        "c_nationkey",
        F.when(F.col("c_nationkey") > 20, F.lit("> 89")).otherwise(F.col("c_nationkey").cast("string")).alias("age_text"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_nationkey") % 12 + 1).alias("month"),
    )
    ships = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("shipped")
    )
    at = F.col("o_orderdate")
    birth = timeframe.birth_date(
        F.lit(None).cast("timestamp"), F.col("c_nationkey") + 1940, F.col("month"), F.lit(None)
    )
    age = F.when(F.col("age_text") == "> 89", 300).otherwise(timeframe.as_long(F.col("age_text")))
    return (
        table(spark, d, "orders")
        .join(patients, "o_custkey", "left")
        .join(ships, "o_orderkey", "left")
        .select(
            "o_orderkey",
            timeframe.age_from_anchor(at, F.lit(1980), F.col("c_nationkey") + 20).alias("anchor_age"),
            F.round(timeframe.age_from_birth(at.cast("timestamp"), birth), 6).alias("birth_age"),
            age.cast("bigint").alias("text_age"),
            F.least(age, F.lit(90)).cast("bigint").alias("capped_age"),
            F.coalesce("shipped", "o_orderdate").alias("start_ts"),
            timeframe.whole_minutes_between(at, F.coalesce("shipped", "o_orderdate")).alias("INTIME"),
        )
    )


# ---- events -------------------------------------------------------------------------------


def timed_events(spark, d):
    return table(spark, d, "events").select(
        F.col("user_id").alias("hadm_id"), own_block(3).alias("stay_id"), "event_id", "ts", "event_type", "value"
    )


@query
def align_abs(spark, d):
    aligned = events.align(timed_events(spark, d), stays(spark, d, 3), "abs", "ts", 48)
    return aligned.select("stay_id", "event_id", "TIME")


@query
def align_min(spark, d):
    """Offsets in minutes since entry of the event's own stay, re-keyed to all sibling stays."""
    cohort = stays(spark, d, 3)
    offset = timeframe.whole_minutes_between(F.col("in_ts"), F.col("ts"))
    own = timed_events(spark, d).join(cohort.select("stay_id", "in_ts"), "stay_id").withColumn("offset", offset)
    return events.align(own, cohort, "min", "offset", 48).select("stay_id", "event_id", "TIME")


@query
def align_ms(spark, d):
    cohort = stays(spark, d, 3)
    offset = F.floor((timeframe.epoch_micros(F.col("ts")) - F.col("admit_s") * 1_000_000) / 1000)
    own = timed_events(spark, d).join(cohort.select("stay_id", "admit_s"), "stay_id").withColumn("offset", offset)
    aligned = events.align(own, cohort, "ms", "offset", 48)
    return aligned.select("stay_id", "event_id", "TIME")


@query
def code_lookup(spark, d):
    looked_up = events.attach_dictionary(
        table(spark, d, "lineitem"),
        table(spark, d, "part"),
        "l_partkey",
        "p_partkey",
        {"p_name": "l_partkey", "p_brand": "p_brand"},
        {"p_type": "ECONOMY"},
    )
    return looked_up.select("l_orderkey", "l_linenumber", "original_code_l_partkey", "l_partkey", "p_brand")


@query
def ed_attach(spark, d):
    visits = table(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    attached = events.attach_visit(
        table(spark, d, "lineitem"), visits, "l_orderkey", {"o_custkey": "hadm_id", "o_orderdate": "ED_INTIME"}
    )
    return attached.select("l_orderkey", "l_linenumber", "hadm_id", "ED_INTIME")


@query
def latest_k_events(spark, d):
    found = events.latest_clock_events(
        measurements(spark, d), stays(spark, d, 3), "hadm_id", 48, 5, ["event_id"]
    )
    return found.select("stay_id", "event_id", "TIME")


# ---- laboratory labels --------------------------------------------------------------------


def lab_cohort(spark, d, days=3):
    cohort = stays(spark, d, days)
    first = labs.first_exclusion(exclusion_events(spark, d), "hadm_id")
    return cohort.join(first, "hadm_id", "left")


def lab_medians(spark, d, exact=True):
    tagged = labs.tag_measures(measurements(spark, d), EVENT_MEASURES)
    found = labs.horizon_medians(tagged, stays(spark, d, 3), "hadm_id", rules(exact=exact))
    return found.select("stay_id", "measure", "horizon", F.round("value", 6).alias("value"))


@query
def lab_horizon_median(spark, d):
    return lab_medians(spark, d)


@query
def lab_horizon_median_approx(spark, d):
    return lab_medians(spark, d, exact=False)


def buckets(spark, d, closed):
    bands = event_bands(closed)
    return table(spark, d, "events").select(
        "event_id",
        bands["creatinine"].label("value").alias("rising"),
        bands["platelets"].label("round(value)").alias("falling"),
        labs.task_bands("wbc", closed).label("round(value)").alias("wbc"),
        labs.task_bands("creatinine", closed, values.CREATININE_UMOL_PER_MG_DL).label("value").alias("scaled"),
    )


@query
def lab_bucket_left(spark, d):
    return buckets(spark, d, "left")


@query
def lab_bucket_right(spark, d):
    return buckets(spark, d, "right")


def wide_labels(spark, d):
    cohort = lab_cohort(spark, d)
    return labs.lab_labels(measurements(spark, d), cohort, "hadm_id", rules(), TASKS, EVENT_MEASURES)


@query
def lab_labels_wide(spark, d):
    filled = labels.fill_missing(wide_labels(spark, d).drop("admit_s", "in_ts", "exclusion_s"))
    return filled.select("stay_id", *labels.label_columns(filled))


@query
def baseline_first(spark, d):
    tagged = labs.tag_measures(measurements(spark, d), {"creatinine": ["error"]})
    return labs.baseline(tagged, stays(spark, d, 3), "hadm_id")


def aki(spark, d, combine):
    found = labs.lab_labels(
        measurements(spark, d), stays(spark, d, 3), "hadm_id", rules(combine=combine), ["urine", "AKI"], EVENT_MEASURES
    )
    return found.select("stay_id", *[f"AKI_{h}" for h in (1, 2, 3)])


@query
def aki_stage_skip(spark, d):
    return aki(spark, d, "skip")


@query
def aki_stage_propagate(spark, d):
    return aki(spark, d, "propagate")


@query
def row_max_modes(spark, d):
    """Row-wise maximum of two columns with gaps, skipping or propagating nulls."""
    a = F.when(F.pmod("o_orderkey", F.lit(3)) != 0, F.pmod("o_custkey", F.lit(7)))
    b = F.when(F.pmod("o_orderkey", F.lit(5)) != 0, F.pmod("o_custkey", F.lit(4)))
    return table(spark, d, "orders").select(
        "o_orderkey", row_max(a, b).alias("skip"), row_max(a, b, missing="propagate").alias("propagate")
    )


@query
def urine_per_weight(spark, d):
    found = labs.lab_labels(
        measurements(spark, d), stays(spark, d, 3), "hadm_id", rules(), ["urine"], EVENT_MEASURES
    )
    return found.select("stay_id", "weight", "urine_1", "urine_2", "urine_3")


@query
def exclude_after_first(spark, d):
    first = labs.first_exclusion(exclusion_events(spark, d), "hadm_id")
    rows = measurements(spark, d).where(F.col("code") != "error").join(first, "hadm_id", "left")
    return labs.before_exclusion(rows).select("event_id", "hadm_id", "clock_s", "exclusion_s")


@query
def exclude_multi_patient(spark, d):
    admissions = stays(spark, d, 10).select("stay_id", "hadm_id", F.col("hadm_id").alias("patient_id"))
    excluded = exclusion_events(spark, d).select(F.col("hadm_id").alias("patient_id"))
    patients = labs.multi_stay_excluded(admissions, excluded)
    return labs.drop_patients(admissions, patients)


@query
def excluded_patient_count(spark, d):
    """Patients before and after the exclusion filter."""
    first = labs.first_exclusion(exclusion_events(spark, d), "hadm_id")
    rows = measurements(spark, d).join(first, "hadm_id", "left")
    kept = F.col("exclusion_s").isNull() | (F.col("exclusion_s") > F.col("clock_s"))
    return rows.agg(
        F.countDistinct("hadm_id").alias("patients"),
        F.countDistinct(F.when(kept, F.col("hadm_id"))).alias("patients_kept"),
    )


@query
def unit_normalise_text(spark, d):
    units = {"click": "umol/L", "view": " mg/L ", "error": "/uL", "signup": "mmol/L", "purchase": "L"}
    unit = F.create_map(*[F.lit(x) for item in units.items() for x in item])[F.col("event_type")]
    return table(spark, d, "events").select(
        "event_id",
        *[
            F.round(values.normalise_by_unit_text(F.col("value"), unit, m, "10"), 6).alias(m)
            for m in ("creatinine", "platelets", "hb", "urine")
        ],
    )


@query
def unit_normalise_id(spark, d):
    unit = F.get_json_object("props", "$.k").try_cast("int") % 4 + 8645
    scaled = values.normalise_by_unit_id(F.col("value"), unit, {8648: 1, 8647: 1000})
    return (
        table(spark, d, "events")
        .select("event_id", F.round(scaled, 6).alias("value"))
        .where(F.col("value").isNotNull())
    )


@query
def label_stats(spark, d):
    labelled = wide_labels(spark, d).drop("admit_s", "in_ts", "exclusion_s")
    return labels.label_stats(labelled)


@query
def label_stats_wide(spark, d):
    labelled = wide_labels(spark, d).drop("admit_s", "in_ts", "exclusion_s")
    wide = labels.label_stats_wide(labels.label_stats(labelled), [-1, 0, 1, 2, 3, 4])
    return wide.withColumnsRenamed({str(x): f"label_{x}" if x >= 0 else "label_missing" for x in range(-1, 5)})


# ---- diagnosis ----------------------------------------------------------------------------


@query
def crosswalk_prefix(spark, d):
    part = table(spark, d, "part")
    crosswalk = part.where(F.pmod("p_partkey", F.lit(4)) != 0).select(
        F.col("p_brand").alias("icd10cm"), F.col("p_type").alias("icd9cm"), F.col("p_partkey").alias("line")
    )
    kind = F.pmod("p_partkey", F.lit(3))
    code = (
        F.when(kind == 0, F.col("p_brand"))
        .when(kind == 1, F.concat("p_brand", F.lit("x"), F.col("p_size").cast("string")))
        .otherwise(F.concat(F.lit("Q"), F.col("p_size").cast("string")))
    )
    rows = part.select("p_partkey", code.alias("code"), (F.pmod("p_size", F.lit(5)) == 0).alias("is_current"))
    mapping = diagnosis.crosswalk_codes(rows.where(~F.col("is_current")), crosswalk, order="line")
    return diagnosis.convert_codes(rows, mapping, "code", F.col("is_current"))


@query
def diagnosis_set(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", diagnosis.without_rare_class(F.pmod("l_partkey", F.lit(18))).alias("category")
    )
    cohort = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    attached = diagnosis.attach_sets(cohort, diagnosis.category_sets(rows, "l_orderkey"), "l_orderkey")
    return attached.select("l_orderkey", joined(F.col("diagnosis"), ",").alias("diagnosis"))


@query
def path_majority(spark, d):
    part = table(spark, d, "part").withColumn("path", F.concat_ws("|", "p_type", "p_brand", "p_name"))
    known = part.where(F.pmod("p_partkey", F.lit(4)) != 0).select("path", F.pmod("p_size", F.lit(5)).alias("category"))
    return diagnosis.path_categories(part, known, depth=3)


@query
def category_map(spark, d):
    texts = {
        "click": "Operative Cardiovascular",
        "view": "Neurologie - overig",
        "error": "Niet operatief Interne Geneeskunde",
        "signup": "Non-operative musculo-skeletal",
        "purchase": "Trauma",
    }
    text = F.create_map(*[F.lit(x) for item in texts.items() for x in item])[F.col("event_type")]
    key = diagnosis.specialty_key(text, F.col("event_type") == "view")
    group = F.get_json_object("props", "$.k").try_cast("int") % 17 + 98
    return table(spark, d, "events").select(
        "event_id",
        diagnosis.literal_category(key, diagnosis.SPECIALTY_CATEGORY).alias("specialty"),
        diagnosis.literal_category(group, diagnosis.ADMISSION_GROUP_CATEGORY).alias("admission_group"),
    )


# ---- encoding -----------------------------------------------------------------------------


def event_text():
    ratio = F.round(F.col("value") / 7, 6).cast("decimal(18,6)").cast("string")
    return F.concat_ws(" ", "event_type", F.col("value").cast("decimal(18,2)").cast("string"), ratio, "props")


@query
def dpe_encode(spark, d):
    texts = table(spark, d, "events").select("event_id", event_text().alias("raw"))
    rounded = texts.select("event_id", round_decimals("raw").alias("text"))
    return rounded.select(
        "event_id", "text", joined(token_list("text")).alias("tokens"), joined(digit_places("text")).alias("places")
    )


LINE_COLUMNS = [
    "l_quantity", "l_returnflag", "l_linestatus", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    "original_code_l_partkey", "l_partkey", "p_brand", "p_type",
]


def coded_lines(spark, d):
    """Every column of lineitem; numbers as decimals, so that both engines print them alike."""
    money = "CAST({0} AS DECIMAL(14, 2)) AS {0}"
    lines = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        "CAST(l_quantity AS DECIMAL(10, 1)) AS l_quantity", *[money.format(c) for c in ("l_extendedprice", "l_discount", "l_tax")],
        "CAST(l_shipdate AS DATE) AS l_shipdate",
    )
    return events.attach_dictionary(
        lines, table(spark, d, "part"), "l_partkey", "p_partkey",
        {"p_name": "l_partkey", "p_brand": "p_brand", "p_type": "p_type"},
    )


def linearised_lines(spark, d, units=False):
    return encode.linearise(
        coded_lines(spark, d), "lineitem", LINE_COLUMNS, ["original_code_l_partkey"], keep=("l_orderkey", "l_linenumber"), units=units
    )


@query
def event_linearise(spark, d):
    rows = linearised_lines(spark, d)
    return rows.select(
        "l_orderkey", "l_linenumber", joined(F.col("tokens")).alias("tokens"), joined(F.col("types")).alias("types"),
        joined(F.col("places")).alias("places"), "original_text", joined(F.col("codes")).alias("codes"),
    )


@query
def vocab_build(spark, d):
    tokens = table(spark, d, "documents").select(token_list("text").alias("tokens"))
    return encode.build_vocabulary(tokens)


@query
def vocab_encode(spark, d):
    lines = linearised_lines(spark, d, units=True).select("l_orderkey", "l_linenumber", "units", "codes")
    rows = saved(lines, "lines")
    encoded = encode.encode_tokens(rows, encode.build_vocabulary(rows), separator=" ")
    return encoded.select("l_orderkey", "l_linenumber", "ids", joined(F.col("codes")).alias("codes"))


def event_sequences(spark, d, max_events=256, max_tokens=128, hours=48):
    """As in a full run: latest events first, then text work, a vocabulary of what is kept, ids."""
    cohort = stays(spark, d, 3)
    seen = measurements(spark, d).join(table(spark, d, "events").select("event_id", "props"), "event_id")
    kept = events.latest_clock_events(seen, cohort, "hadm_id", hours, max_events, ["event_id"])
    shaped = kept.selectExpr(
        "stay_id", "TIME", "event_id", "CAST(value AS DECIMAL(18, 2)) AS value",
        "code AS original_code_event_type", "code AS event_type", "props",
    )
    rows = saved(
        encode.linearise(
            shaped, "events", ["value", "original_code_event_type", "event_type", "props"],
            ["original_code_event_type"], max_tokens, ("stay_id", "TIME", "event_id"),
        ),
        "events",
    )
    encoded = encode.encode_tokens(rows, encode.build_vocabulary(rows))
    return encode.stay_sequences(encoded, cohort.select("stay_id"), max_events, max_tokens, hours, ["event_id"])


@query
def hourly_offsets(spark, d):
    """Start index per hour over the latest events of a stay (at most 256)."""
    kept = events.latest_clock_events(measurements(spark, d), stays(spark, d, 3), "hadm_id", 48, 256, ["event_id"])
    times = kept.groupBy("stay_id").agg(F.collect_list("TIME").alias("times"))
    return times.select("stay_id", joined(encode.hourly_offsets(F.col("times"), 48)).alias("hi_start"))


@query
def sequence_pad(spark, d):
    return flat_sequences(event_sequences(spark, d))


def flat_sequences(packed):
    def flat(name):
        return joined_numbers(F.flatten(F.col(name))).alias(name)

    return packed.select(
        "stay_id", flat("hi_input"), flat("hi_type"), flat("hi_place"),
        joined(F.col("hi_start")).alias("hi_start"), joined(F.col("time")).alias("time"),
        joined(F.col("original_texts"), "; ").alias("original_texts"), joined(F.col("codes")).alias("codes"),
    )


# ---- text ---------------------------------------------------------------------------------


def text_counts(spark, d):
    found = []
    for name, keys in (("documents", ["lang"]), ("conversations", [])):
        frame = table(spark, d, name)
        found.append(words.word_counts(frame, name, words.text_columns(frame, keys)))
    return words.union_counts(found)


@query
def word_freq(spark, d):
    return text_counts(spark, d)


@query
def word_freq_enriched(spark, d):
    enriched = events.attach_dictionary(
        table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus"), table(spark, d, "part"), "l_partkey", "p_partkey",
        {"p_name": "l_partkey", "p_brand": "p_brand", "p_type": "p_type"},
    ).drop("original_code_l_partkey")
    return words.word_counts(enriched, "lineitem", words.text_columns(enriched))


def classified(spark, d):
    """Word counts with languages; the languages are those of the labelled documents."""
    labelled = table(spark, d, "documents").where("lang IS NOT NULL")
    found = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    return language.classify_counts(text_counts(spark, d), language.train(labelled, "text", "lang", found), found)


@query
def lang_id_words(spark, d):
    return classified(spark, d).select("table", "column", "word", "lang", "prob", "cnt")


@query
def lang_distribution(spark, d):
    return language.distribution(classified(spark, d))


# ---- scans, sinks, helpers ----------------------------------------------------------------


@query
def quantile_bins(spark, d):
    binned = quantiles.quantile_bins(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10)
    return binned.select("o_orderkey", F.concat(F.lit("price_"), F.col("bin")).alias("price_bin"))


@query
def sample_rows(spark, d):
    return readers.read_raw(
        spark, f"{d}/orders.parquet", "parquet", ["o_orderkey", "o_custkey"], sample=0.1, sample_key="o_orderkey"
    )


@query
def optional_source_present(spark, d):
    """Orders with a table that this source does ship."""
    path = scratch_path(spark, "death")
    table(spark, d, "customer").selectExpr("c_custkey AS o_custkey", "c_acctbal AS death_value").write.parquet(path)
    found = readers.read_optional(spark, path, "o_custkey bigint, death_value double", format="parquet")
    return table(spark, d, "orders").join(found, "o_custkey", "left").select("o_orderkey", "death_value")


@query
def label_stats_sink(spark, d):
    """Label statistics in CSV, read back."""
    path = scratch_path(spark, "label-stats")
    labelled = wide_labels(spark, d).drop("admit_s", "in_ts", "exclusion_s")
    writers.write_stats(labels.label_stats(labelled), path)
    return readers.read_raw(spark, path, schema="task string, label bigint, n bigint")


@query
def distribution_sink(spark, d):
    """Language distribution in JSON, one folder per level, read back."""
    path = scratch_path(spark, "distribution")
    writers.write_distribution(language.distribution(classified(spark, d)), path)
    schema = "level string, table string, column string, lang string, cnt bigint"
    return spark.read.schema(schema).json(path).select("level", "table", "column", "lang", "cnt")


@query
def word_languages_sink(spark, d):
    """Language of each word, one folder per table, read back."""
    path = scratch_path(spark, "word-languages")
    writers.write_word_languages(classified(spark, d), path)
    return spark.read.parquet(path).select("table", "column", "word", "lang", "prob", "cnt")


@query
def diagnosis_inner(spark, d):
    """Only orders with a diagnosis other than the rare class; codes are cleaned of blanks and points first."""
    text = F.concat(F.lit(" "), F.pmod("l_partkey", F.lit(18)).cast("string"), F.lit(". "))
    code = F.replace(F.trim(text), F.lit("."), F.lit(""))
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", diagnosis.without_rare_class(code.cast("int")).alias("category")
    )
    cohort = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    attached = diagnosis.attach_sets(cohort, diagnosis.category_sets(rows, "l_orderkey"), "l_orderkey", "inner")
    return attached.select("l_orderkey", joined(F.col("diagnosis"), ",").alias("diagnosis"))


ALL_MEASURES = {
    "creatinine": ["error"], "platelets": ["click"], "wbc": ["view"], "hb": ["signup"], "urine": ["purchase"],
    "bicarbonate": ["click2"], "sodium": ["view2"],
}


@query
def lab_labels_all(spark, d):
    """All eight laboratory tasks in one pass; every third click and view stands for a further measure."""
    code = "CASE WHEN event_type IN ('click', 'view') AND event_id % 3 = 0 THEN concat(event_type, '2') ELSE event_type END"
    seen = table(spark, d, "events").selectExpr(
        "user_id AS hadm_id", "event_id", f"{code} AS code", "unix_timestamp(ts) AS clock_s", "value"
    )
    tasks = [*TASKS[:-1], "bicarbonate", "sodium", "AKI"]
    found = labels.fill_missing(labs.lab_labels(seen, lab_cohort(spark, d), "hadm_id", rules(), tasks, ALL_MEASURES))
    return found.select("stay_id", *[f"{t}_{h}" for t in tasks for h in (1, 2, 3)])


@query
def encoded_union(spark, d):
    """Two event tables linearised, put together, the latest 256 of each stay kept, in the order of a file."""
    cohort = stays(spark, d, 3)
    parts = []
    for name, kinds in (("visits", "'click', 'view'"), ("orders", "'error', 'signup', 'purchase'")):
        seen = table(spark, d, "events").where(f"event_type IN ({kinds})").selectExpr(
            "user_id AS hadm_id", "event_id", "event_type", "CAST(value AS DECIMAL(18, 2)) AS value", "unix_timestamp(ts) AS clock_s"
        )
        kept = events.latest_clock_events(seen, cohort, "hadm_id", 48, 256, ["event_id"])
        parts.append(encode.linearise(kept, name, ["event_type", "value"], keep=("stay_id", "TIME", "event_id")))
    latest = events.latest_events(events.union_all(parts), 256, ["event_id"])
    return latest.select("stay_id", "TIME", "event_id", "original_text").orderBy("stay_id", "TIME", "event_id")


@query
def csv_scan(spark, d):
    """A directory of gzipped CSV files, read as text with two columns, then cast."""
    path = scratch_path(spark, "orders-csv")
    table(spark, d, "orders").write.option("header", True).option("compression", "gzip").csv(path)
    raw = readers.read_raw(spark, path, columns=["o_orderkey", "o_totalprice", "o_orderdate"])
    return raw.select(
        timeframe.as_long(F.col("o_orderkey")).alias("o_orderkey"),
        timeframe.as_double(F.col("o_totalprice")).alias("o_totalprice"),
        F.col("o_orderdate").try_cast("timestamp_ntz").alias("o_orderdate"),
    )


@query
def csv_typed_scan(spark, d):
    path = scratch_path(spark, "supplier-csv")
    table(spark, d, "supplier").write.option("header", True).csv(path)
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return readers.read_raw(spark, path, schema=schema)


@query
def latin1_csv(spark, d):
    """Whole document texts through an ISO-8859-1 file.

    The file holds the UTF-8 bytes of a text as Latin-1 characters, and line ends as the control
    characters 1 and 2, which no text has, so that a record is one line.
    """
    path = scratch_path(spark, "latin1")
    spelled = F.decode(F.encode(F.translate("text", "\n\r", "\x01\x02"), "UTF-8"), "ISO-8859-1")
    shaped = table(spark, d, "documents").select("doc_id", F.concat(F.lit("|"), spelled, F.lit("|")).alias("text"))
    shaped.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    back = readers.read_raw(spark, path, encoding="ISO-8859-1")
    plain = F.decode(F.encode(F.expr("substring(text, 2, length(text) - 2)"), "ISO-8859-1"), "UTF-8")
    return back.select(timeframe.as_long(F.col("doc_id")).alias("doc_id"), F.translate(plain, "\x01\x02", "\n\r").alias("text"))


@query
def dirty_csv(spark, d):
    """Lines with stray quotes, too many and too few fields."""
    path = scratch_path(spark, "dirty")
    kind = F.pmod("p_partkey", F.lit(10))
    quoted = F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))
    key = F.col("p_partkey").cast("string")
    line = (
        F.when(kind == 0, F.concat_ws(",", key, quoted, "p_brand", F.lit("spare")))
        .when(kind == 1, F.concat_ws(",", key, quoted))
        .otherwise(F.concat_ws(",", key, quoted, F.concat(F.col("p_brand"), F.lit('"'))))
    )
    table(spark, d, "part").select(line.alias("value")).write.text(path)
    return readers.read_dirty_csv(spark, path, ["p_partkey", "p_name", "p_brand"]).select(
        timeframe.as_long(F.col("p_partkey")).alias("p_partkey"), "p_name", "p_brand"
    )


@query
def quoted_classes(spark, d):
    """A class table whose values are wrapped in single quotes."""
    path = scratch_path(spark, "classes")
    wrap = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    table(spark, d, "part").select(
        wrap(F.concat("p_name", F.lit("   "))).alias("code"), wrap(F.col("p_size").cast("string")).alias("level")
    ).write.option("header", True).csv(path)
    return readers.classes_of(readers.read_raw(spark, path), "code", "level")


@query
def optional_source(spark, d):
    """Orders with a death table that this source does not ship."""
    missing = readers.read_optional(spark, f"{d}/death.parquet", "o_custkey bigint, death_ts timestamp", format="parquet")
    return table(spark, d, "orders").join(missing, "o_custkey", "left").select("o_orderkey", "death_ts")


@query
def label_sink(spark, d):
    """Label table written as CSV and read back."""
    path = scratch_path(spark, "labels")
    filled = labels.fill_missing(wide_labels(spark, d).drop("admit_s", "in_ts", "exclusion_s"))
    tasks = labels.label_columns(filled)
    writers.write_labels(filled, path, tasks)
    return readers.read_raw(spark, path, schema=", ".join(["stay_id bigint", *[f"{t} int" for t in tasks]]))


@query
def sequence_sink(spark, d):
    """Per-stay arrays written by bucket and read back."""
    path = scratch_path(spark, "sequences")
    writers.write_sequences(event_sequences(spark, d), path)
    return flat_sequences(spark.read.parquet(path))


@query
def word_count_sink(spark, d):
    path = scratch_path(spark, "words")
    writers.write_word_counts(text_counts(spark, d), path)
    back = spark.read.schema("table string, column string, word string, cnt bigint").json(path)
    return back.select("table", "column", "word", "cnt")


@query
def cached_cohort(spark, d):
    """Cohort saved under its settings and loaded from there."""
    settings = {"obs": 48, "folder": d}
    folder = scratch_path(spark, "cache")
    build = lambda: cohorts.build_cohort(stays(spark, d, 10), 48).select("stay_id", "LOS")
    writers.cached(spark, folder, "cohort", settings, build)
    return writers.cached(spark, folder, "cohort", settings, build, reuse=True)
