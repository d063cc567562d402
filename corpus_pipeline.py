"""The training-data pipeline: five stages, each over all that the one before it kept.

All but the last return the columns of their input, whatever they are.  Rows are judged each: a
null doc_id is one of its own, and repeated rows are kept or dropped as their stage says.  An empty
table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers
from tidemark.llm import byte_bpe, decontamination, line_dedup, ngram_jaccard, quality_classifier
from tidemark.sources.folders import shared_folder

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes to be of quality 1; a null text is an empty one."""
    return quality_classifier.keep_good(docs, _table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines, however short, that repeat an earlier one; those left without words go.

    Null and empty texts, which have no lines with words, stay as they are.
    """
    return line_dedup.drop_repeated_lines(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id.

    Documents without words, null texts too, are like nothing and stay.
    """
    return ngram_jaccard.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; a null or empty text holds none."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digests of the ids and of what they decode to.

    A null text is encoded as an empty one, to no ids.
    """
    encoded = byte_bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id", "n_tokens", "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_similar),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokens),
]

#: SQL cannot express the learned classifier; tests/llm/test_plainly.py holds each stage against a
#: plain recomputation of the rows that it keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each is written to the shared folder for the next to read."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
