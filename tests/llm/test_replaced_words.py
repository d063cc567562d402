"""Decontamination with every choice of replaced words that the stated share allows."""

import itertools

import pytest

from tests.llm.helpers import documents
from tidemark.llm import common, decontamination
from tidemark.llm.decontamination import EQUAL_PERCENT, MASKS, OVERLAP


def replaced(n, k):
    """The words of an item of n with k of them replaced, in each way."""
    for places in itertools.combinations(range(n), k):
        yield " ".join("zzz" if i in places else f"n{n}w{i}" for i in range(n))


@pytest.mark.parametrize("n", MASKS)
def test_masks_leave_out_all_allowed_replacements(n):
    allowed = max(k for k in range(n) if 100 * (n - k) >= EQUAL_PERCENT * n)
    seeds = [{at + k for k in mask} for mask in MASKS[n] for at in range(n - mask[-1])]
    for places in itertools.combinations(range(n), allowed):
        assert any(seed.isdisjoint(places) for seed in seeds)
    assert n < 5 or all(len(mask) <= mask[-1] for mask in MASKS[n])


@pytest.fixture(params=["broadcast", "shuffled"])
def joined(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    return request.param


def test_all_allowed_replacements_are_found(spark, joined):
    items, rows, expected = [], [], set()
    for n in range(1, OVERLAP + 1):
        items.append((n, " ".join(f"n{n}w{i}" for i in range(n))))
        for k in range(min(n, 3) + 1):
            for text in replaced(n, k):
                if 100 * (n - k) >= EQUAL_PERCENT * n:
                    expected.add((len(rows), n))
                rows.append((len(rows), f"before it {text} after it"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_leaks(documents(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert all(r.hits > 0 and r.first_word >= 2 for r in found)


def test_two_words_of_thirteen_within_a_longer_item(spark):
    item = [f"w{i}" for i in range(40)]
    rows = []
    for at, places in itertools.product((0, 13, 27), itertools.combinations(range(OVERLAP), 2)):
        part = ["zzz" if i in places else item[at + i] for i in range(OVERLAP)]
        rows.append((len(rows), " ".join(["x", *part, "y"])))
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id for r in decontamination.find_leaks(documents(spark, rows), benchmark).collect()}
    assert found == {i for i, _ in rows}


def test_a_passage_counts_in_every_row_and_item(spark, joined):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"x {item} y"), (1, f"x {item} y"), (None, item), (2, None), (3, "w1 w2"), (4, item.upper()), (5, "")]
    docs = documents(spark, rows).selectExpr("*", "1 AS item", "2 AS words", "3 AS start", "4 AS key", "5 AS tag", "6 AS n")
    items = [(7, item), (8, item), (9, None), (9, " "), (None, "w1 w2")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS n")
    found = {(r.doc_id, r.item_id): (r.hits, r.first_word) for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert found[4, 7] == found[4, 8] == found[None, 7] and found[1, 7][0] == 2 * found[4, 7][0]
    assert found[3, None] == (1, 0) and found[4, None] == (1, 1) and found[1, None] == (2, 2)
    assert {doc_id for doc_id, _ in found} == {1, 3, 4, None} and 9 not in {item_id for _, item_id in found}
    assert [r.doc_id for r in decontamination.drop_leaks(docs, benchmark).orderBy("doc_id").collect()] == [2, 5]


def test_no_words_are_shuffled_with_the_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    schemas = []
    monkeypatch.setattr(decontamination, "stage", lambda df, name: schemas.append((name, df.columns)) or common.stage(df, name))
    decontamination.find_leaks(documents(spark, ["a b c d e"]), spark.createDataFrame([(1, "b c d e")], "item_id long, text string"))
    assert dict(schemas)["places"] == ["doc_id", "tag", "start", "mask", "item", "item_start", "n"]
