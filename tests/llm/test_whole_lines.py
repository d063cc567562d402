"""Line dedup against brute force."""

import random
import re
import time
from collections import defaultdict

import corpus_pipeline
from tests.llm.helpers import documents
from tidemark.llm import line_dedup

SF_DIR = "/root/testdata/sf0.001"


def lines_of(text):
    return [tuple(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w) for line in (text or "").split("\n")]


def brute_force(rows, min_edited=line_dedup.MIN_EDITED):
    """(doc_id, line_no, first_doc_id, first_line_no, edits) of each repeated line."""
    places = defaultdict(list)
    for doc_id, text in sorted(rows):
        for line_no, words in enumerate(lines_of(text)):
            if words:
                places[words].append((doc_id, line_no))
    holes, gaps = defaultdict(list), defaultdict(list)
    edited = [words for words in places if len(words) >= min_edited]
    for words in edited:
        for i in range(len(words)):
            holes[words[:i], words[i + 1 :]].append(words)
            gaps[words[:i] + words[i + 1 :]].append(words)
    found = set()
    for words, where in places.items():
        source = where[0]
        if len(words) >= min_edited:
            cuts = [(words[:i], words[i + 1 :]) for i in range(len(words))]
            near = {w for cut in cuts for w in holes[cut]} | set(gaps[words])
            near |= {a + b for a, b in cuts if len(a + b) >= min_edited and a + b in places}
            source = min([source, *(places[w][0] for w in near)])
        found |= {(*at, *source, int(source != where[0])) for at in where if source < at}
    return found


def found_in(docs):
    columns = ["doc_id", "line_no", "first_doc_id", "first_line_no", "edits"]
    return {tuple(r) for r in line_dedup.repeated_lines(docs).select(*columns).collect()}


def test_every_line_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute_force(rows)
    assert expected and found_in(docs) == expected


def test_random_lines_with_few_words(spark):
    rng = random.Random(5)
    rows = [
        (i, "\n".join(" ".join(rng.choices("abcd", k=rng.choice([0, 1, 2, 3, 3, 4, 5, 7, 9]))) for _ in range(8)))
        for i in range(60)
    ]
    docs = documents(spark, rows).selectExpr("*", "1 AS tag", "2 AS k1", "3 AS ord", "4 AS place", "5 AS kind", "6 AS n")
    assert found_in(docs) == brute_force(rows)


def test_null_texts_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "one two three"), (3, "one two three four"), (4, "x\nx"), (4, "x\nx"), (5, " \t\n")]
    found = line_dedup.repeated_lines(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.line_no, r.first_doc_id, r.first_line_no, r.edits) for r in found) == [
        (3, 0, None, 0, 1), (4, 1, 4, 0, 0), (4, 1, 4, 0, 0),
    ]
    assert line_dedup.repeated_lines(documents(spark, rows).where("false")).count() == 0
    assert line_dedup.drop_repeated_lines(documents(spark, rows)).where("text IS NULL").count() == 1


def test_long_near_lines(spark):
    words = [f"w{i * i % 9973}" for i in range(40_000)]
    other, shorter = list(words), words[:30_000] + words[30_001:]
    other[12_345] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(shorter)), (4, " ".join(reversed(words)))]
    start = time.monotonic()
    assert found_in(documents(spark, rows)) == {(2, 0, 1, 0, 1), (3, 0, 1, 0, 1)}
    assert time.monotonic() - start < 60


def test_pipeline_removes_short_repeats(spark):
    rows = [
        (1, "Home\nhttps://example.net/a?b=c\nread more\nfour words are here"), (2, "own text\nhome\nREAD  more"),
        (3, "https://example.net/a?b=c\n\n"), (4, "four words were here\nwords are here"), (5, "three words only"),
    ]
    docs = documents(spark, rows)
    left = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, docs, SF_DIR).collect()}
    assert left == {1: rows[0][1], 2: "own text", 5: "three words only"}
    assert found_in(docs) == brute_force(rows)
