"""From raw documents to token ids: language, shared lines, near duplicates, source mix, encoding.

Every stage takes (spark, docs, folder of the tables) and works on all rows that its predecessor kept;
all but the last return the columns of ``documents``.  ``run`` writes each stage's rows as Parquet in
the shared folder and reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import bpe, jaccard, langid, line_dedup, mixing
from stayline.llm.common import WORD, drop_path, new_path, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Predictions below this posterior probability are rejected.
LEAST_SCORE = 0.4
#: A letter, as ``langid.LETTERS`` takes it, for Java's patterns.
LETTER = "\\p{L}"


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejects documents without a language: no letters, or a prediction below ``LEAST_SCORE``.

    A missing ``lang`` is filled with the prediction.  If no row teaches a language, every document
    that has letters stays, its missing ``lang`` filled with ``und``.
    """
    found = langid.identify(docs)
    # Only where nothing was learned is a text with letters unknown.
    unlearned = (F.col("lang_pred") == langid.UNKNOWN) & F.coalesce(F.col("text").rlike(LETTER), F.lit(False))
    found = found.where(unlearned | ((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes shared lines out of the texts; a document left without a word by that goes."""
    kept = line_dedup.dedup_lines(docs)
    kept = kept.where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard.keep_smallest(docs, words=5, percent=80).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or up to three times."""
    mixed = mixing.mix_sources(docs).where("repeats > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each row, and the digests of the ids and of the bytes they decode to."""
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = bpe.decode(bpe.encode(docs, vocabulary).select("doc_id", "lang", "source", "n_tokens", "ids"), vocabulary)
    digests = {"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    return rows.withColumns(digests).drop("decoded")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]

#: Language ID, which fits a model, is not expressible in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents").select(COLUMNS), None
    for _, stage in STAGES:
        path = new_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
