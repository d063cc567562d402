"""Tiles that come in parts, and pairs that meet by blocks."""

import numpy as np
import pandas as pd

from tests.llm.helpers import documents
from tidemark.llm import ngram_jaccard


def _batches(rows, size):
    return (rows.iloc[at : at + size] for at in range(0, len(rows), size))


def test_a_tile_in_parts_gives_the_pairs_of_the_whole(monkeypatch):
    rng = np.random.default_rng(5)
    key = rng.choice([3, 5, 8, 9, 11, 12], 2_000, p=[0.6, 0.2, 0.15, 0.045, 0.004, 0.001])
    c = rng.integers(0, 700, 2_000)
    rows = pd.DataFrame({"key": key, "c": c, "n": 20 + c % 90}).sort_values(["key", "n", "c"], ignore_index=True)

    def found():
        out = pd.concat(list(ngram_jaccard._candidates(_batches(rows, 64))))
        members = out[out["key"].notna()]
        pairs = out[out["key"].isna()]
        assert not members.duplicated().any()
        return set(zip(pairs["a"], pairs["b"])), set(zip(members["key"], members["a"], members["n"]))

    whole = found()
    monkeypatch.setattr(ngram_jaccard, "CHUNK", 50)
    assert found() == whole


def test_blocks_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(160):
        words = list(base)
        for at in rng.choice(120, 1 + k % 6, replace=False):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    docs = documents(spark, texts)
    rows = lambda: {(r.doc_id, r.component_id) for r in ngram_jaccard.link_documents(docs).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    expected = set(enumerate(root))
    assert rows() == expected
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 7)
    monkeypatch.setattr(ngram_jaccard, "FIRST_KEYS", 1)
    assert rows() == expected
