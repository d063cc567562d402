"""Removal of repeated byte strings against brute force."""

import random

import pytest

from tests.llm.helpers import documents
from tidemark.llm.suffix_dedup import LENGTH, remove_repeats


def brute_force(rows):
    """(doc_id, kept bytes, spans) of rows with different doc_ids."""
    first = {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        for i in range(len(data) - LENGTH + 1):
            first.setdefault(data[i : i + LENGTH], (doc_id, i))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            if first[data[i : i + LENGTH]] < (doc_id, i):
                gone[i : i + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, bytes(b for b, g in zip(data, gone) if not g), spans))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [letters(n) for n in (99, 100, 101, 150, 400)]
    texts = ["x" * 500, "ab" * 300, "", None, "short", shared[4], shared[4], shared[3] * 3]
    for _ in range(60):
        parts = [rng.choice([letters(rng.randint(0, 120)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 60):]])
                 for _ in range(rng.randint(1, 5))]
        texts.append("".join(parts))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("hot", [20_000, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_brute_force(spark, seed, hot):
    rows = corpus(seed)
    found = remove_repeats(documents(spark, rows).repartition(5), hot).collect()
    assert sorted((r.doc_id, bytes(r.kept), len(r.spans)) for r in found) == brute_force(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = remove_repeats(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, bytes(r.kept), len(r.spans)) for r in found) == brute_force(rows)


def test_repeated_rows_and_one_id_for_two_texts(spark):
    a, b = "".join(chr(97 + i * i % 23) + str(i) for i in range(80)), "".join(str(i * 7) for i in range(90))
    docs = documents(spark, [(1, a), (1, a), (2, a), (3, b), (3, "zz" + b), (None, b)])
    kept = sorted((r.doc_id is not None and r.doc_id, bytes(r.kept).decode()) for r in remove_repeats(docs).collect())
    assert kept == sorted([(False, b), (1, a), (1, a), (2, ""), (3, ""), (3, "zz")])


def test_empty_table_and_clashing_columns(spark):
    docs = documents(spark, ["a"]).selectExpr("*", "1 AS tag", "2 AS at", "3 AS kind", "4 AS marks")
    assert [r.n_bytes for r in remove_repeats(docs).collect()] == [1]
    assert remove_repeats(docs.where("false")).collect() == []
