"""Language probabilities against the sum over all segmentations, for words of any length."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import documents
from tidemark.llm import language_id, queries
from tidemark.llm.language_id import Lattice

PIECES = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "aab": 5, "bba": 6, "ba": 7}


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    lattice = Lattice(PIECES)
    probabilities = rng.random((len(PIECES) + 1, 3)) + 0.01
    logs = np.log(probabilities / probabilities.sum(0))
    return lattice, logs, lattice.weights(logs)


def plainly(word, logs):
    """Log of the sum over all segmentations, by the pieces that end at each place, in logarithms."""
    marked = "▁" + word
    upto = [np.zeros(logs.shape[1])]
    for j in range(1, len(marked) + 1):
        terms = [
            upto[i] + logs[PIECES.get(marked[i:j], len(PIECES))]
            for i in range(max(0, j - 4), j) if marked[i:j] in PIECES or i == j - 1
        ]
        upto.append(np.logaddexp.reduce(terms))
    return upto[-1]


WORDS = ["a", "ab" * 20, "aabba" * 12 + "abc", "b" * 63, "b" * 64, "b" * 65, "aabbab" * 12, "abxba" * 400, "x" * 3000, "ab" * 5_000]


@pytest.mark.parametrize("word", WORDS, ids=lambda w: f"{w[:5]}{len(w)}")
def test_scores_of_words_of_any_length(model, word):
    lattice, logs, weights = model
    found = lattice.score_long(word.encode(), weights)
    assert found == pytest.approx(plainly(word, logs), rel=1e-9)
    if not language_id.is_long(word.encode()):
        assert lattice.score([word.encode()], weights)[0] == pytest.approx(found, rel=1e-9)


def test_expected_counts_do_not_hang_on_how_they_are_computed(model, monkeypatch):
    lattice, _, weights = model
    counts = Counter({w.encode(): n for n, w in enumerate(WORDS[:6], 1)})
    together = lattice.expected(counts, weights[:, [1]])
    monkeypatch.setattr(language_id, "LONGEST", 0)
    one_by_one = lattice.expected(counts, weights[:, [1]])
    assert one_by_one == pytest.approx(together, rel=1e-6)
    letters = sum(n * (len(w.decode()) + 1) for w, n in counts.items())
    assert (together * lattice.lengths).sum() == pytest.approx(letters, rel=1e-6)


def test_documents_against_a_plain_recomputation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    langs, logs = language_id.fit(docs, queries.PIECES)
    pieces = language_id.vocabulary(queries.PIECES)
    by_length = defaultdict(set)
    for piece in pieces:
        by_length[len(piece)].add(piece)
    unknown = len(logs) - 1

    def score(word):
        marked = "▁" + word
        upto = [np.zeros(len(langs))]
        for j in range(1, len(marked) + 1):
            terms = [upto[j - n] + logs[pieces[marked[j - n : j]]] for n in by_length if n <= j and marked[j - n : j] in by_length[n]]
            if marked[j - 1] not in by_length[1]:
                terms.append(upto[j - 1] + logs[unknown])
            upto.append(np.logaddexp.reduce(terms))
        return upto[-1]

    texts = [r.text or "" for r in docs.collect()][:12] + ["straße" * 40 + " und"]
    found = {r.doc_id: r for r in language_id.detect_languages(
        documents(spark, texts).unionByName(docs.where("false"), allowMissingColumns=True), queries.PIECES).collect()}
    assert len(found) == len(texts)
    from unittest.mock import patch
    with patch.object(language_id, "fit", lambda *_: (langs, logs)):
        found = {r.doc_id: r for r in language_id.detect_languages(documents(spark, texts), queries.PIECES).collect()}
    for i, text in enumerate(texts):
        words = [w.decode() for w in language_id.words_in(text)]
        if not words:
            continue
        total = sum(map(score, words))
        best = int(total.argmax())
        assert found[i].lang_pred == langs[best]
        assert math.isclose(found[i].score, 1 / np.exp(total - total[best]).sum(), rel_tol=1e-6)
