"""Operators and every stage of the pipeline against plain recomputations in one process."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

import corpus_pipeline
from tests.llm.helpers import documents
from tests.llm.test_whole_lines import brute_force
from tidemark.llm import quality_classifier, sharding
from tidemark.llm.decontamination import EQUAL_PERCENT, OVERLAP

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# -- sharding


def shards_plainly(rows, shards):
    sized = sorted(
        ((doc_id is not None, doc_id or 0, zlib.crc32((text or "").encode()), len((text or "").encode()) + 8), doc_id)
        for doc_id, text in rows
    )
    total, before, slots, found = sum(k[3] for k, _ in sized), 0, {}, []
    for (_, _, crc, size), doc_id in sized:
        shard = before * shards // total
        slots[shard] = slots.get(shard, -1) + 1
        found.append((doc_id, size, crc, "bytes", shard, slots[shard], None))
        before += size
    return sorted(found, key=repr)


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards(spark, shards):
    rng = random.Random(shards)
    rows = [(rng.choice([None, *range(90)]), rng.choice([None, "", "ä" * rng.randint(0, 400), "same"])) for _ in range(150)]
    found = sorted(map(tuple, sharding.shard(documents(spark, rows), shards).collect()), key=repr)
    assert found == shards_plainly(rows, shards)


# -- quality classifier


def features_plainly(text):
    words, lines, chars = words_of(text), (text or "").split("\n"), len(text or "")
    share = lambda part, whole: np.log((part + 0.5) / (whole - part + 1.0))
    of = lambda pattern: len(regex.findall(pattern, text or ""))
    n = len(words)
    return [
        np.log1p(n), np.log1p(chars / (n + 1)), np.log1p(n / len(lines)), share(of(r"\p{Lu}"), chars), share(of(r"\p{Nd}"), chars),
        share(of(r"[#*$%&|<>@=_~^]"), chars), share(of(r"[!?]"), chars), share(of(r"[.,;:]"), chars),
        share(len(set(words)), n), share(sum(a == b for a, b in zip(words, words[1:])), n), share(len(set(lines)), len(lines)),
    ]


def scores_plainly(rows, labels):
    """Probability of class 1 by densities written out with inverses and determinants."""
    x = {doc_id: np.array(features_plainly(text)) for doc_id, text in rows}
    learned = {d: q for d, q in labels if q in (0, 1) and d in x and zlib.crc32(str(d).encode()) % 3 != 1}
    of = [np.array([x[d] for d, q in learned.items() if q == k]) for k in (0, 1)]
    scatter = [(c - c.mean(0)).T @ (c - c.mean(0)) for c in of]
    pooled = sum(scatter) / len(learned)
    a, b = quality_classifier.TOWARDS_POOLED, quality_classifier.TOWARDS_DIAGONAL
    logs = []
    for c, s in zip(of, scatter):
        covariance = (1 - b) * ((1 - a) * s / len(c) + a * pooled) + b * np.diag(np.diag(pooled) + 1e-3)
        inverse, (_, log_det) = np.linalg.inv(covariance), np.linalg.slogdet(covariance)
        prior = np.log(len(c) / len(learned))
        logs.append({d: prior - 0.5 * log_det - 0.5 * (v - c.mean(0)) @ inverse @ (v - c.mean(0)) for d, v in x.items()})
    return {d: 1 / (1 + np.exp(-np.clip(logs[1][d] - logs[0][d], -30, 30))) for d in x}


def tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    return docs, labels


def test_scores_and_the_first_stage(spark):
    docs, labels = tables(spark)
    expected = scores_plainly(rows_of(docs, "doc_id", "text"), rows_of(labels, "doc_id", "quality"))
    found = {r.doc_id: r for r in quality_classifier.score_quality(docs, labels).collect()}
    assert {d: r.score for d, r in found.items()} == pytest.approx(expected, rel=1e-6, abs=1e-9)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for d, r in found.items())
    kept = corpus_pipeline.good_quality(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, s in expected.items() if s >= 0.5}


# -- line dedup


def test_the_second_stage(spark):
    docs, _ = tables(spark)
    rows = rows_of(docs, "doc_id", "text")
    gone = {}
    for doc_id, line_no, *_ in brute_force(rows):
        gone.setdefault(doc_id, set()).add(line_no)
    expected = {}
    for doc_id, text in rows:
        left = text
        if doc_id in gone:
            left = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone[doc_id])
        if doc_id not in gone or words_of(left):
            expected[doc_id] = left
    found = corpus_pipeline.without_repeated_lines(spark, docs, SF_DIR)
    assert found.columns == docs.columns and gone
    assert dict(rows_of(found, "doc_id", "text")) == expected
    assert all(n == len(text) for text, n in rows_of(found, "text", "n_chars") if text is not None)


# -- n-gram Jaccard join


def shingles(text):
    words = [w.lower() if w.isascii() else re.sub("[A-Z]", lambda c: c[0].lower(), w) for w in words_of(text)]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_the_third_stage(spark):
    docs, _ = tables(spark)
    sets = {doc_id: shingles(text) for doc_id, text in rows_of(docs, "doc_id", "text")}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    found = corpus_pipeline.one_of_similar(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    kept = [d for (d,) in rows_of(found, "doc_id")]
    assert len(kept) == len(set(kept)) == len({find(d) for d in ids}) < len(ids)
    assert {find(d) for d in kept} == {find(d) for d in ids}
    texts = dict(rows_of(docs, "doc_id", "text"))
    assert all(texts[d] == text for d, text in rows_of(found, "doc_id", "text"))


# -- benchmark decontamination


def leaks(text, items):
    words = words_of((text or "").lower())
    for item in items:
        n = min(OVERLAP, len(item))
        for at in range(len(words) - n + 1):
            part = words[at : at + n]
            if any(100 * sum(a == b for a, b in zip(part, item[i : i + n])) >= EQUAL_PERCENT * n for i in range(len(item) - n + 1)):
                return True
    return False


def test_the_fourth_stage(spark):
    docs, _ = tables(spark)
    items = [words_of(t.lower()) for (t,) in rows_of(spark.read.parquet(f"{SF_DIR}/benchmark.parquet"), "text")][:40]
    texts = dict(rows_of(docs, "doc_id", "text"))
    # Documents that hold a word of an item in common are looked at in full; the others cannot leak.
    runs = {tuple(item[i : i + 4]) for item in items for i in range(len(item) - 3)}
    near = {
        d for d, text in texts.items()
        if not runs.isdisjoint(zip(*[words_of((text or "").lower())[k:] for k in range(4)]))
    }
    expected = {d for d in texts if d not in near or not leaks(texts[d], items)}
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    from tidemark.llm import decontamination
    found = decontamination.drop_leaks(docs, benchmark)
    assert found.columns == docs.columns and len(expected) < len(texts)
    assert {d for (d,) in rows_of(found, "doc_id")} == expected


# -- byte-level BPE


def test_the_last_stage(spark):
    docs, _ = tables(spark)
    with open(corpus_pipeline.BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(rows_of(docs, "doc_id", "text"))
    found = {r.doc_id: r for r in corpus_pipeline.tokens(spark, docs, SF_DIR).collect()}
    assert set(found) == set(texts)
    for doc_id, text in texts.items():
        ids = encoding.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        r = found[doc_id]
        assert (r.n_tokens, bytes(r.ids), r.ids_sha256) == (len(ids), packed, hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
