"""The operators on small tables: nulls, empty and long texts, ties, clashing columns, brute force."""

import base64
import hashlib
import itertools
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import documents
from tests.oracle import connect, difference
from tidemark.llm import (
    byte_bpe, decontamination, language_id, line_dedup, ngram_jaccard, quality_classifier, quality_rules, queries,
    sharding, url_filters,
)

SF_DIR = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word " * 60_000), (5, "a b c\nA  b c"), (5, "a b c\nA  b c"), (None, "one two three")]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD).selectExpr("*", "1 AS size", "2 AS words", "3 AS n", "4 AS key", "5 AS c", "6 AS part")


@pytest.mark.parametrize("name", queries.ORACLE)
def test_agrees_with_sql(spark, name):
    with connect(SF_DIR) as connection:
        assert difference(spark, connection, queries.QUERIES[name], queries.ORACLE[name], SF_DIR) is None


def test_odd_documents(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    n = len(ODD)
    assert quality_rules.apply_quality_rules(odd).count() == n
    assert sharding.shard(odd).count() == n
    assert ngram_jaccard.link_documents(odd).count() == n
    scores = quality_classifier.score_quality(odd, labels).collect()
    assert len(scores) == n and all(0 <= r.score <= 1 for r in scores)
    found = language_id.detect_languages(odd, queries.PIECES).collect()
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3)} == {"und"} and len(found) == n
    assert queries.bpe_digests(odd).count() == n
    assert decontamination.find_leaks(odd, spark.createDataFrame([(1, None)], "item_id long, text string")).count() == 0


def test_empty_tables(spark):
    docs = documents(spark, ["a"]).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for rows in (
        quality_rules.apply_quality_rules(docs), line_dedup.repeated_lines(docs), sharding.shard(docs),
        quality_classifier.score_quality(docs, labels), language_id.detect_languages(docs, queries.PIECES),
        queries.bpe_digests(docs), decontamination.find_leaks(docs, items), ngram_jaccard.link_documents(docs),
        url_filters.judge_urls(pages),
    ):
        assert rows.collect() == []


def test_shards_are_contiguous_and_even(spark):
    docs = documents(spark, [(i, "x" * (i * 37 % 300)) for i in range(2_000)]).repartition(6)
    rows = sorted(sharding.shard(docs).collect(), key=lambda r: r.doc_id)
    assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
    total = sum(r["size"] for r in rows)
    for shard, group in itertools.groupby(rows, key=lambda r: r["shard"]):
        group = list(group)
        assert [r["slot"] for r in group] == list(range(len(group)))
        assert abs(sum(r["size"] for r in group) - total / 24) <= 2 * 308


def test_bpe_as_the_library(spark):
    name = queries.BPE_RANKS
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(name, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["it's 'll we'LL " * 4_000, "x" * 40_000, " \n" * 20_000 + "a", "Ñ🙂 9!? 　" * 5_000, "", "plain text"]
    for row in queries.bpe_digests(documents(spark, texts)).collect():
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_decode_returns_the_bytes(spark):
    docs = documents(spark, ["héllo wörld", ""])
    encoded = byte_bpe.encode(docs, queries.BPE_RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, queries.BPE_RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in decoded) == ["", "héllo wörld"]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_links_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    parent = {i: i for i in sets}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.link_documents(docs).collect()}
    assert found == {(i, len(s), root(i)) for i, s in sets.items()}


def test_learned_operators_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    right = queries.op3_quality_classifier(spark, sf_dir).where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int"))
    ).first()[0]
    assert right > 0.95
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right = queries.op5_language_id(spark, sf_dir).where("held_out").join(docs, "doc_id").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))
    ).first()[0]
    assert right > 0.97


def test_near_lines(spark):
    base = "the quick brown fox jumps over the lazy dog today"
    rows = [
        (1, base), (2, base.replace("brown", "red")), (3, base + " again"), (4, base.replace("lazy ", "")),
        (5, base.replace("brown", "red").replace("lazy", "old")), (6, base.upper()), (7, "short line"), (8, "short line"),
    ]
    found = {(r.doc_id, r.first_doc_id, r.edits) for r in line_dedup.repeated_lines(documents(spark, rows)).collect()}
    assert found == {(2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 2, 1), (6, 1, 0), (8, 7, 0)}
    left = {r.doc_id for r in line_dedup.drop_repeated_lines(documents(spark, rows)).collect()}
    assert left == {1, 7}


def test_leaks_bear_replaced_words(spark):
    item = " ".join(f"w{i}" for i in range(30))
    near = " ".join("zzz" if i in (5, 20) else f"W{i}" for i in range(30))
    docs = documents(spark, [(1, "some text " + near + " more"), (2, " ".join(f"w{i}" for i in range(8)) + " other words"), (3, item)])
    items = spark.createDataFrame([(7, item), (8, "a few words here now")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, items).collect()} == {(1, 7), (3, 7)}


def test_pipeline_runs_its_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(rows) < docs.count() and all(r.n_tokens * 4 == len(r.ids) for r in rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
