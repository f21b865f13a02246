"""Language of single words by character n-grams, and language distributions.

The model is multinomial naive Bayes over n-grams of 1 to 3 characters, its counts aggregated by
Spark from labelled text.  Log probabilities are whole micro-nats, so sums do not depend on the
order of rows or on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.words import words_of

SIZES = (1, 2, 3)
EDGE = "_"
MICRO = 1_000_000


def grams(word: str) -> Column:
    """All n-grams of a word (SQL), marked at both ends."""
    marked = f"concat('{EDGE}', {word}, '{EDGE}')"
    sizes = [
        f"transform(sequence(1, length({marked}) - {n - 1}), i -> substring({marked}, i, {n}))" for n in SIZES
    ]
    return F.expr(f"concat({', '.join(sizes)})")


def gram_counts(labelled: DataFrame, text: str, label: str, languages: list[str]) -> DataFrame:
    """One row per n-gram with its count in each language.

    Words are counted before they are cut into n-grams, so the explosion runs over distinct
    (language, word) pairs and not over the text.
    """
    counted = (
        labelled.where(F.col(label).isin(*languages))
        .select(F.col(label).alias("lang"), F.explode(words_of(F.col(text))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    per_language = [
        F.sum(F.when(F.col("lang") == lang, F.col("cnt")).otherwise(0)).alias(lang) for lang in languages
    ]
    return counted.select("lang", "cnt", F.explode(grams("word")).alias("gram")).groupBy("gram").agg(*per_language)


def train(labelled: DataFrame, text: str, label: str, languages: list[str]) -> DataFrame:
    """Model rows (gram, weight per language) plus one row with a null gram for unseen n-grams.

    Totals and weights share the shuffle of the counts.
    """
    counts = gram_counts(labelled, text, label, languages)
    totals = counts.agg(
        F.struct(
            F.count(F.lit(1)).alias("_kinds"), *[F.sum(lang).alias(lang) for lang in languages]
        ).alias("_totals")
    )
    with_unseen = counts.unionByName(
        totals.select(F.lit(None).cast("string").alias("gram"), *[F.lit(0).cast("bigint").alias(x) for x in languages])
    )
    attached = with_unseen.withColumn("_totals", totals.scalar())

    def weight(lang: str) -> Column:
        chance = (F.col(lang) + 1) / (F.col("_totals")[lang] + F.col("_totals")["_kinds"])
        return F.round(F.ln(chance) * MICRO).cast("bigint")

    return attached.select("gram", *[weight(lang).alias(lang) for lang in languages])


def classify(counts: DataFrame, model: DataFrame, languages: list[str]) -> DataFrame:
    """Distinct words with ``lang`` and ``prob`` (3 decimals); equal priors.

    The most probable language wins, the first by name among equals.  A model that was saved has
    a known size; a small one is broadcast and the n-grams of a word stay in its task.
    """
    # the counts are read as well, so that this use shares the shuffle of the counts
    distinct = counts.groupBy("word").agg(F.sum("cnt").alias("_total")).where("_total > 0")
    unseen = model.where("gram IS NULL").select(F.struct(*languages).alias("_u"))
    cut = distinct.select("word", F.explode(grams("word")).alias("gram"))
    joined = cut.join(model.where("gram IS NOT NULL"), "gram", "left").withColumn("_u", unseen.scalar())
    scores = joined.groupBy("word").agg(
        *[F.expr(f"sum(coalesce({lang}, _u.{lang})) AS {lang}") for lang in languages]
    )
    best = f"greatest({', '.join(languages)})"
    spread = " + ".join(f"exp(({lang} - {best}) / {MICRO})" for lang in languages)
    chosen = ", ".join(f"CASE WHEN {lang} = {best} THEN '{lang}' END" for lang in sorted(languages))
    return scores.selectExpr(
        "word", f"coalesce({chosen}, 'unknown') AS lang", f"coalesce(round(1.0D / ({spread}), 3), 0.0D) AS prob"
    )


def classify_counts(counts: DataFrame, model: DataFrame, languages: list[str]) -> DataFrame:
    """Word counts (table, column, word, cnt) with the language of each word."""
    return counts.join(classify(counts, model, languages), "word")


def distribution(classified: DataFrame) -> DataFrame:
    """Counts per language by column, by table and overall, in one pass of grouping sets."""
    by_word = classified.groupBy("table", "column", "lang").agg(F.sum("cnt").alias("cnt"))
    return (
        by_word.groupingSets([["table", "column", "lang"], ["table", "lang"], ["lang"]], "table", "column", "lang")
        .agg(F.sum("cnt").alias("cnt"), F.grouping_id().alias("_level"))
        .select(
            F.when(F.col("_level") == 0, "column").when(F.col("_level") == 2, "table").otherwise("overall").alias("level"),
            "table",
            "column",
            "lang",
            "cnt",
        )
    )
