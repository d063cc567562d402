"""Learned limits: an outlier of each statistic is rejected, and limits move with the number of documents."""

import random

import pytest

from tests.llm.helpers import documents
from tidemark.llm import quality_rules

WORDS = [a + b + c for a in ("be", "sol", "tri", "ma", "un") for b in ("ta", "ri", "o", "lem") for c in ("n", "ret", "s", "dy")]


def ordinary(rng, words=200, symbols=1, dup=1, repeat=0):
    """A text of lines with a few symbols and a repeated line, and so many words of repeated windows."""
    lines = [" ".join(rng.choices(WORDS, k=10)) for _ in range(words // 10)]
    lines += [f"short {i % 3} line" for i in range(3 + dup)]
    text = "\n".join(lines)
    for _ in range(symbols):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice("#*$%&") + text[at:]
    if repeat:
        window = " ".join(rng.choices(WORDS, k=8))
        text += "".join(f"\n{window} {i}" for i in range(repeat))
    return text


def corpus(spark, outlier=None, n=300):
    rng = random.Random(5)
    texts = [ordinary(rng, rng.choice([150, 200, 250]), rng.randint(0, 3), rng.randint(1, 2), rng.choice([0, 0, 2])) for _ in range(n)]
    return documents(spark, texts + ([outlier(rng)] if outlier else []))


def kept(docs):
    return {r.doc_id: r.kept for r in quality_rules.apply_quality_rules(docs).collect()}


@pytest.mark.parametrize("outlier", [
    lambda rng: " ".join("pneumonoultramicroscopic" + w for w in rng.choices(WORDS, k=100)),
    lambda rng: " ".join(rng.choices("abcdefg", k=200)) + "\n" + ordinary(rng, 60),
    lambda rng: ordinary(rng, symbols=120),
    lambda rng: ordinary(rng, dup=60),
    lambda rng: ordinary(rng, 240, repeat=10),
], ids=["long words", "short words", "symbols", "dup_lines", "repeats"])
def test_each_statistic_rejects_its_outlier(spark, outlier):
    found = kept(corpus(spark, outlier))
    assert not found.pop(300) and sum(found.values()) >= 295


def test_odd_documents_and_groups(spark):
    rng = random.Random(1)
    text = ordinary(rng)
    rows = [(i, text, "en", "a") for i in range(30)] + [(40, None, "en", "a"), (41, "", None, None), (None, text, None, None), (42, text, "de", None)]
    docs = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS n", "2 AS total", "3 AS bucket")
    found = quality_rules.apply_quality_rules(docs).collect()
    assert len(found) == 35
    assert {r.doc_id for r in found if not r.kept} == {40, 41}
    assert quality_rules.apply_quality_rules(docs.where("false")).count() == 0


def test_limits_move_from_the_language_to_the_source(spark):
    def limits(n):
        """The highest share of symbols that passes in a source with n documents."""
        stats = [("en", "big", 100, 500, s, 10, 0, 0, False) for s in range(1, 401)]
        stats += [("en", "own", 100, 500, 100 + i % 2, 10, 0, 0, False) for i in range(n)]
        df = spark.createDataFrame(stats, "lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, base_failed boolean")
        sketch = quality_rules.sketches(df)
        own = quality_rules.fences(sketch, "lang", "source").where("source = 'own'").first()
        return own.symbols_n, own.symbols_high
    assert limits(50)[0] == 50 and limits(400)[0] == 400
