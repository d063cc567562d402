"""The alignment of two tokenizers against a plain recomputation."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from tests.llm.helpers import documents
from tidemark.llm import token_alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
SF_DIR = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "word " * 30_000), (5, "a b c\nA  b c"), (5, "a b c\nA  b c"),
    (None, "one two three"), (6, "<|endoftext|> <s> </s> <0x41>"), (7, "naïve 中文 🙂 \u0000 x"), (8, "▁under"),
    (9, "é ﬁ Ａ"), (10, "a\r\n\x0b b" * 50),
]


def plainly(rows):
    """The rows of `align` for (doc_id, text) rows, link by link."""
    both, a_tokenizer = token_alignment.both(*FILES), tokenizers.Tokenizer.from_file(FILES[0])
    a_tokenizer.encode_special_tokens = True
    found, counts = [], Counter()
    for doc_id, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a, b = a_tokenizer.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
            of_a, of_b = [both.a_bytes[i] for i in a], [both.b_bytes[i] for i in b]
            if not b"".join(of_a) == b"".join(of_b) == b" " + text.encode():
                a, b = [], []
            ends_a, ends_b = list(accumulate(map(len, of_a))), list(accumulate(map(len, of_b)))
            i = j = 0
            for end in sorted(set(ends_a) & set(ends_b)) if a else []:
                k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
                links.append((a[k - 1], b[m - 1]))
                i, j = k, m
        counts.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    highest = {}
    for (a, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return [
        (
            doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, groups, links in found
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"run_links": 300, "fan_in": 3}])
def test_agrees_with_plain_counts(spark, limits):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = plainly([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(token_alignment.align(docs, *FILES, **limits)) == sorted(expected, key=repr)


def test_odd_documents(spark):
    docs = documents(spark, ODD).selectExpr("*", "1 AS run", "2 AS doc", "3 AS radix", "4 AS n_a", "5 AS counts")
    found = rows_of(token_alignment.align(docs, *FILES))
    assert found == sorted(plainly(ODD), key=repr)
    assert [r[1:] for r in found if r[0] in (1, 2)] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert any(r[0] == 6 and r[1] > 0 for r in found)
    rng, signs = random.Random(2), [*"ab zéß中🙂.,!?'\n\t \u2003\u180e\x85\x1c\ufeff<>|1٣½  ", "<s>", "<|endoftext|>", " don't", "'s"]
    mixed = [(i, "".join(rng.choices(signs, k=rng.randint(1, 60)))) for i in range(1000)]
    assert rows_of(token_alignment.align(documents(spark, mixed), *FILES)) == sorted(plainly(mixed), key=repr)
    none = token_alignment.align(docs.where("false"), *FILES)
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_merge_adds_equal_pairs():
    rng, runs, expected = np.random.default_rng(1), [], Counter()
    for size in (0, 1, 9000, 20_000, 5):
        pairs = np.unique(rng.integers(0, 30_000, size).astype(np.uint64) << np.uint64(20))
        counts = rng.integers(1, 9, len(pairs)).astype(np.uint64)
        expected.update(dict(zip(pairs.tolist(), counts.tolist())))
        runs.append(token_alignment.pack_counts(pairs, counts))
    merged = token_alignment.CountRun(token_alignment.merge(runs))
    found = []
    while len(merged.pairs):
        found += zip(merged.pairs.tolist(), merged.counts.tolist())
        merged.advance()
    assert found == sorted(expected.items())
