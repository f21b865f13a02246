"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import bpe, collocation, convrepair, jaccard, langid, licenses, line_dedup, linecrf, mixing, onebit, sharding, warc, wavelet
from stayline.llm.common import new_path, table


def op3_minimax_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, 24).drop("text")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op8_subset_sum_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).drop("text", "source")


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The whole join: components, and of each document the number of its links."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(docs, words=4, percent=85)


def op2_word_backoff_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_line_crf_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = linecrf.fit(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    return linecrf.rate_documents(docs, model).drop("text")


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = bpe.decode(bpe.encode(docs, vocabulary).drop("text"), vocabulary)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = new_path(spark, "wavelet")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    manifest = wavelet.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), files)
    return wavelet.read_documents(manifest, files, with_ids=False)


def op4_zstd_warc(spark: SparkSession, folder: str) -> DataFrame:
    files = new_path(spark, "warc")
    archives = warc.write_archives(table(spark, folder, "pages"), files)
    records = warc.read_archives(spark, archives, files, with_payload=False)
    page = lambda name: F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op5_one_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    return onebit.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return convrepair.repair_conversations(table(spark, folder, "conversations"))


def op12_hat_trie_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocation.mine(table(spark, folder, "documents").select("text", "lang"))


def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


QUERIES = {
    f.__name__: f
    for f in (
        op5_one_bit_codes,
        op4_zstd_warc,
        op1_wavelet_tokens,
        op6_byte_bpe,
        op9_line_crf_quality,
        op2_word_backoff_langid,
        op3_minimax_sharding,
        op7_line_dedup,
        op8_subset_sum_mix,
        op10_jaccard_join,
        op11_conversation_repair,
        op12_hat_trie_collocations,
        op13_license_scan,
    )
}
