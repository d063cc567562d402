"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    byte_bpe, decontamination, language_id, line_dedup, ngram_jaccard, quality_classifier, quality_rules,
    sharding, structure_repair, suffix_dedup, token_alignment, url_filters, warc,
)
from tidemark.llm.common import new_path

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_quality_rules(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents")).drop("tag")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.detect_languages(table(spark, sf_dir, "documents"), PIECES)


def bpe_digests(docs: DataFrame) -> DataFrame:
    encoded = byte_bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.link_documents(table(spark, sf_dir, "documents")).drop("tag")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = structure_repair.damage(table(spark, sf_dir, "conversations"))
    return structure_repair.summarise(structure_repair.repair(damaged))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES, public_tokenizers.PATTERN)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_line_dedup, op3_quality_classifier, op4_url_filters, op5_language_id,
        op6_byte_bpe, op7_sharding, op8_decontamination, op9_suffix_dedup, op10_ngram_jaccard,
        op11_warc, op12_structure_repair, op13_token_alignment,
    )
}

ORACLE = {
    "op1_quality_rules": quality_rules.oracle_sql(),
    "op2_line_dedup": line_dedup.oracle_sql(),
    "op4_url_filters": url_filters.oracle_sql(),
    "op8_decontamination": decontamination.oracle_sql(),
    "op11_warc": warc.oracle_sql(),
}
