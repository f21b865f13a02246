"""Diagnosis labels: code crosswalk, category sets, path hierarchies, literal maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMAPPED = "NaN"
# The rare level-1 class (counted from 0) that is dropped; later classes move down.
RARE_CLASS = 14


def prefixes(text: Column) -> Column:
    """All prefixes of a code, the code itself included."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text))), lambda n: F.substring(text, F.lit(1), n)
    )


def majority(votes: DataFrame, keys: list[str], choice: str, out: str) -> DataFrame:
    """Most frequent choice per key, the smallest one on ties; two combinable aggregates."""
    counted = votes.groupBy(*keys, choice).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(F.min(F.struct(-F.col("_n"), F.col(choice)))[choice].alias(out))


def crosswalk_codes(
    codes: DataFrame,
    crosswalk: DataFrame,
    source: str = "icd10cm",
    target: str = "icd9cm",
    order: str | None = None,
    prefix_fallback: bool = True,
) -> DataFrame:
    """Target code (``converted``) of each distinct source code in the column ``code``.

    An exact entry counts first (the last one by ``order``, or the largest target, among
    duplicates).  Otherwise the longest prefix that is itself an entry is taken, with the most
    frequent target among the entries that start with it.  Everything else is ``"NaN"``.
    """
    wanted = codes.select("code").where(F.col("code").isNotNull()).distinct()
    rank = F.col(order) if order else F.col(target)
    exact = crosswalk.groupBy(F.col(source).alias("code")).agg(F.max_by(target, rank).alias("_exact"))
    found = wanted.join(exact, "code", "left")
    if not prefix_fallback:
        return found.select("code", F.coalesce("_exact", F.lit(UNMAPPED)).alias("converted"))
    entries = crosswalk.select(F.col(source).alias("_entry"), F.col(target).alias("_target")).where(
        F.col("_target").isNotNull()
    )
    started = entries.select(F.explode(prefixes(F.col("_entry"))).alias("prefix"), "_target")
    known = exact.select(F.col("code").alias("prefix"))
    modal = majority(started.join(known, "prefix", "left_semi"), ["prefix"], "_target", "_modal")
    missing = found.where(F.col("_exact").isNull()).select(
        "code", F.explode(prefixes(F.col("code"))).alias("prefix")
    )
    by_prefix = (
        missing.join(modal, "prefix")
        .groupBy("code")
        .agg(F.max_by("_modal", F.length("prefix")).alias("_by_prefix"))
    )
    return found.join(by_prefix, "code", "left").select(
        "code", F.coalesce("_exact", "_by_prefix", F.lit(UNMAPPED)).alias("converted")
    )


def convert_codes(
    diagnoses: DataFrame, mapping: DataFrame, code: str, is_current: Column, out: str = "converted"
) -> DataFrame:
    """Codes of the current version as they are, all others through the mapping."""
    looked_up = mapping.select(F.col("code").alias(code), F.col("converted").alias("_to"))
    return (
        diagnoses.join(looked_up, code, "left")
        .withColumn(out, F.when(is_current, F.col(code)).otherwise(F.col("_to")))
        .drop("_to")
    )


def without_rare_class(category: Column) -> Column:
    """Class number with the rare class removed (null) and the later ones moved down."""
    return F.when(category < RARE_CLASS, category).when(category > RARE_CLASS, category - 1)


def category_sets(rows: DataFrame, key: str, category: str = "category") -> DataFrame:
    """Sorted set of categories per key, as ``diagnosis``."""
    return (
        rows.where(F.col(category).isNotNull())
        .groupBy(key)
        .agg(F.sort_array(F.collect_set(F.col(category).cast("int"))).alias("diagnosis"))
    )


def attach_sets(cohort: DataFrame, sets: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Sets joined to the cohort; with ``left``, stays without a diagnosis get an empty array."""
    joined = cohort.join(sets, key, how)
    if how == "inner":
        return joined
    return joined.withColumn("diagnosis", F.coalesce("diagnosis", F.array().cast("array<int>")))


def path_categories(
    paths: DataFrame, known: DataFrame, separator: str = "|", min_depth: int = 2, depth: int | None = None
) -> DataFrame:
    """Category of every path: its own, else that of its longest known prefix.

    ``known`` has (path, category).  A prefix takes its own category where it has one and
    otherwise the majority of its children, from the deepest level upwards (smallest category on
    ties).  Only prefixes of at least ``min_depth`` parts are used.  The vote is one grouped
    count per level.  ``depth`` is the number of parts of the deepest known path; without it one
    aggregate reads it.
    """
    breaking = f"\\Q{separator}\\E"
    parts = F.split(F.col("path"), breaking)
    distinct = known.groupBy("path").agg(F.min("category").alias("category"))
    own = distinct.withColumn("depth", F.size(parts))
    deepest = depth if depth is not None else own.agg(F.max("depth")).first()[0] or 0

    def parent(path: Column, steps: int) -> Column:
        return F.array_join(F.slice(F.split(path, breaking), 1, steps - 1), separator)

    nodes, below = [], None
    for level in range(deepest, min_depth - 1, -1):
        here = own.where(F.col("depth") == level).select("path", "category", F.lit(0).alias("_voted"))
        if below is not None:
            votes = below.select(parent(F.col("path"), level + 1).alias("path"), "category")
            voted = majority(votes, ["path"], "category", "category").withColumn("_voted", F.lit(1))
            here = here.unionByName(voted).groupBy("path").agg(F.min_by("category", "_voted").alias("category"))
        below = here.select("path", "category")
        nodes.append(below)

    every = paths.select("path").where(F.col("path").isNotNull()).distinct()
    matched = every.join(own.select("path", F.col("category").alias("_own")), "path", "left")
    if not nodes:
        return matched.select("path", F.col("_own").alias("category"))
    unknown = matched.where(F.col("_own").isNull() & (F.size(parts) > min_depth)).select(
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(min_depth), F.size(parts) - 1),
                lambda n: F.struct(
                    n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), separator).alias("prefix")
                ),
            )
        ).alias("_up"),
    )
    inferred = (
        unknown.select("path", "_up.*")
        .join(reduce(DataFrame.unionByName, nodes).withColumnRenamed("path", "prefix"), "prefix")
        .groupBy("path")
        .agg(F.max_by("category", "depth").alias("_inferred"))
    )
    return matched.join(inferred, "path", "left").select("path", F.coalesce("_own", "_inferred").alias("category"))


def literal_category(text: Column, mapping: dict, unknown: str = "error") -> Column:
    """Category by a small literal map; null stays null, an unknown text is an error or (``"null"``) null."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), text)
    if unknown == "null":
        return F.when(text.isNotNull(), found)
    missing = F.raise_error(F.concat(F.lit("no category for: "), text.cast("string")))
    return F.when(text.isNull(), F.lit(None)).otherwise(F.coalesce(found, missing.cast("int")))


# Admission specialties (English and Dutch) and their category.
SPECIALTY_CATEGORY = {
    "cardiovascular": 0,
    "cardiovasculair": 0,
    "thoraxchirurgie": 1,
    "respiratory": 2,
    "respiratoir": 2,
    "neurochirurgie": 3,
    "neurologic": 3,
    "neurologisch": 3,
    "neurologie": 3,
    "algemene chirurgie": 1,
    "genitourinary": 4,
    "renaal": 4,
    "gastro-intestinal": 5,
    "gastro-intestinaal": 5,
    "gastro": 5,
    "hematological": 6,
    "hematologisch": 6,
    "hematology": 6,
    "transplant": 7,
    "trauma": 8,
    "metabolic": 9,
    "metabolisme": 9,
    "musculoskeletal /skin": 10,
    "musculo-skeletal": 10,
    "interne geneeskunde": 11,
    "interne geneeskunde _old_1": 11,
    "post": 12,
    "non": 12,
}
# Items that hold a specialty, and those whose text has a suffix after "-".
SPECIALTY_ITEMS = ("13110", "16651", "18588", "16997", "18669", "18671")
SPECIALTY_SUFFIXED = ("18669", "18671")

# Admission group codes of two score versions and their category.
ADMISSION_GROUP_CATEGORY = {
    98: 0,
    190: 0,
    99: 1,
    191: 1,
    100: 2,
    192: 2,
    101: 3,
    193: 3,
    102: 4,
    197: 5,
    103: 6,
    194: 6,
    104: 7,
    195: 7,
    105: 8,
    196: 8,
    106: 9,
    198: 9,
    107: 10,
    199: 10,
    108: 11,
    200: 11,
    109: 12,
    201: 12,
    110: 13,
    202: 13,
    111: 14,
    203: 14,
    112: 15,
    204: 15,
    113: 16,
    205: 16,
    114: 16,
    206: 4,
}
# The variables that hold an admission group code.
ADMISSION_GROUP_ITEMS = ("9990002", "9990004")


def specialty_key(value: Column, has_suffix: Column) -> Column:
    """Lower-case specialty: before "-" where suffixed, after "operative" / "operatief"."""
    head = F.when(has_suffix, F.split_part(value, F.lit("-"), F.lit(1))).otherwise(value)
    after = F.element_at(F.split(F.lower(head), "operative|operatief"), -1)
    return F.trim(after)
