"""Language of a text by unigram pieces, summed over all ways to segment it."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

#: Documents of each language, about, that the probabilities are learned from.
FIT_DOCUMENTS = 1_000
#: Rounds of expectation and maximisation, the first from equal probabilities of all pieces.
ROUNDS = 2
#: Weight, in pieces, that the distribution over all languages has in that of each.
PRIOR = 200.0
#: Longer words are computed one by one, shorter ones together.
LONGEST = 64
#: Numbers of an array in which words are computed together: words times languages.
AT_ONCE = 200_000
#: Texts of one batch that a task works on.
BATCH = 1_000
UNDETERMINED = "und"

_TO_SPACE = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
_START = "▁"  # what the vocabulary puts before a word


def vocabulary(model_file: str) -> dict[str, int]:
    """The pieces of a fixed vocabulary and their numbers."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {
        pieces.id_to_piece(i): i
        for i in range(pieces.get_piece_size())
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))
    }


def words_in(text: str) -> list[bytes]:
    """The lower-cased words, cut at white space and at ASCII signs and digits."""
    return text.lower().encode().translate(_TO_SPACE).split()


def is_long(word: bytes) -> bool:
    return len(word) > LONGEST and len(word.decode()) > LONGEST


class Lattice:
    """All segmentations of words into pieces of a vocabulary.

    A character without a piece of its own counts as the piece number `unknown`, so that every
    word has a segmentation.  Words of one length are computed together.  A probability carries
    a factor of e**STEP for each character, which keeps those of long words in range.
    """

    STEP = 2.5
    _FACTOR = np.uint64(0x9E3779B97F4A7C15)
    _BITS = 20

    def __init__(self, pieces: dict[str, int]) -> None:
        self.unknown = max(pieces.values(), default=-1) + 1
        self.longest = max(map(len, pieces), default=1)
        self.pieces = pieces
        self.lengths = np.ones(self.unknown + 1)
        keys = np.zeros(len(pieces), np.uint64)
        for k, (piece, number) in enumerate(pieces.items()):
            self.lengths[number] = len(piece)
            for code in map(ord, piece):
                keys[k : k + 1] = self._longer(keys[k : k + 1], np.uint64(code))
        # Pieces sorted by slot; slots holds the first piece of each, and the end beyond the last.
        order = np.argsort(self._slot(keys), kind="stable")
        self.keys = keys[order]
        self.numbers = np.array(list(pieces.values()), np.int64)[order]
        self.slots = np.searchsorted(self._slot(self.keys), np.arange((1 << self._BITS) + 1))

    def _longer(self, key: np.ndarray, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (key + code + np.uint64(1)) * self._FACTOR

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys ^ (keys >> np.uint64(31))) * self._FACTOR) >> np.uint64(64 - self._BITS)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are pieces, and their numbers."""
        slot = self._slot(keys)
        first, end = self.slots[slot], self.slots[slot + np.uint64(1)]
        rows = np.flatnonzero(first < end)
        found, numbers = [], []
        at = first[rows]
        while len(rows):
            same = self.keys[at] == keys[rows]
            found.append(rows[same])
            numbers.append(self.numbers[at[same]])
            at = at + 1
            more = ~same & (at < end[rows])
            rows, at = rows[more], at[more]
        if not found:
            return rows, rows
        return np.concatenate(found), np.concatenate(numbers)

    def edges(self, words: list[bytes]) -> Iterator[tuple[list[int], int, dict[tuple[int, int], tuple]]]:
        """Words of one length: their places, the length, and of each span the words and pieces."""
        by_length = defaultdict(list)
        marked_words = [_START + word.decode() for word in words]
        for i, word in enumerate(marked_words):
            by_length[len(word)].append(i)
        for n, places in by_length.items():
            marked = np.array([marked_words[i] for i in places], f"<U{n}")
            codes = marked.view(np.uint32).reshape(len(places), n).astype(np.uint64)
            spans = {}
            for i in range(n):
                key = np.zeros(len(places), np.uint64)
                for j in range(i + 1, min(n, i + self.longest) + 1):
                    key = self._longer(key, codes[:, j - 1])
                    rows, numbers = self._find(key)
                    if j == i + 1:
                        single = np.full(len(places), self.unknown)
                        single[rows] = numbers
                        spans[i, j] = slice(None), single
                    elif len(rows):
                        spans[i, j] = rows, numbers
            yield places, n, spans

    def weights(self, logs: np.ndarray) -> np.ndarray:
        return np.exp(logs + self.STEP * self.lengths[:, None])

    def _forward(self, count: int, n: int, spans: dict, weights: np.ndarray) -> np.ndarray:
        """Weight of all segmentations up to each place: place x word x language."""
        upto = np.zeros((n + 1, count, weights.shape[1]))
        upto[0] = 1
        for (i, j), (rows, numbers) in sorted(spans.items(), key=lambda x: x[0][1]):
            upto[j][rows] += upto[i][rows] * weights[numbers]
        return upto

    def _backward(self, count: int, n: int, spans: dict, weights: np.ndarray) -> np.ndarray:
        after = np.zeros((n + 1, count, weights.shape[1]))
        after[n] = 1
        for (i, j), (rows, numbers) in sorted(spans.items(), key=lambda x: -x[0][0]):
            after[i][rows] += after[j][rows] * weights[numbers]
        return after

    def _ending(self, marked: str, j: int) -> Iterator[tuple[int, int]]:
        """Where the pieces begin that end at place j, and their numbers."""
        for i in range(max(0, j - self.longest), j):
            number = self.pieces.get(marked[i:j])
            if number is not None:
                yield i, number
            elif i == j - 1:
                yield i, self.unknown

    def score_long(self, word: bytes, weights: np.ndarray) -> np.ndarray:
        """As `score` for one word of any length, of which only the last `longest` places are held.

        Each language is divided by its greatest weight as it goes on, whose logarithm is added up.
        """
        marked = _START + word.decode()
        held, logs = {0: np.ones(weights.shape[1])}, 0.0
        for j in range(1, len(marked) + 1):
            held[j] = sum(held[i] * weights[number] for i, number in self._ending(marked, j))
            held.pop(j - self.longest, None)
            if j % self.longest == 0:
                greatest = np.max(list(held.values()), axis=0)
                held = {i: values / greatest for i, values in held.items()}
                logs += np.log(greatest)
        return np.log(held[len(marked)]) + logs - self.STEP * len(marked)

    def expected_long(self, word: bytes, weights: np.ndarray) -> np.ndarray:
        """How often each piece is expected in one word of any length; weights of one language."""
        marked, one = _START + word.decode(), weights[:, 0]
        n = len(marked)
        ending = [list(self._ending(marked, j)) for j in range(n + 1)]
        # Both directions are kept in range by a factor of their own at each place.
        upto, scale = np.zeros(n + 1), np.ones(n + 1)
        upto[0] = 1
        for j in range(1, n + 1):
            # What earlier places have been divided by since.
            since = 1.0
            for i, number in reversed(ending[j]):
                since = since if i == j - 1 else 1.0 / np.prod(scale[i + 1 : j])
                upto[j] += upto[i] * one[number] * since
            scale[j] = upto[j]
            upto[j] = 1.0
        after = np.zeros(n + 1)
        after[n] = 1
        total = np.zeros(self.unknown + 1)
        for j in range(n, 0, -1):
            for i, number in ending[j]:
                share = one[number] / np.prod(scale[i + 1 : j + 1]) * after[j]
                after[i] += share
                total[number] += share
        return total

    def score(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language, summed over its segmentations."""
        out = np.empty((len(words), weights.shape[1]))
        for places, n, spans in self.edges(words):
            out[places] = np.log(self._forward(len(places), n, spans, weights)[n]) - self.STEP * n
        return out

    def expected(self, counts: Counter, weights: np.ndarray) -> np.ndarray:
        """How often each piece is expected in words that occur so often; weights of one language."""
        total = np.zeros(self.unknown + 1)
        for word in filter(is_long, counts):
            total += counts[word] * self.expected_long(word, weights)
        words = [word for word in counts if not is_long(word)]
        often = np.array([counts[w] for w in words], float)
        for places, n, spans in self.edges(words):
            upto = self._forward(len(places), n, spans, weights)[..., 0]
            after = self._backward(len(places), n, spans, weights)[..., 0]
            scale = often[places] / upto[n]
            for (i, j), (rows, numbers) in spans.items():
                share = upto[i][rows] * weights[numbers, 0] * after[j][rows] * scale[rows]
                total += np.bincount(numbers, share, len(total))
        return total


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, model_file: str) -> tuple[list[str], np.ndarray]:
    """The languages in order, and the log probability of each piece in each.

    Learns from documents with a text and a language that are not held out: of each language all
    if there are at most FIT_DOCUMENTS, else about that many, chosen by the hash of the doc_id.
    Spark adds up the expected counts of the pieces; what reaches the driver is at most a number
    for each language and piece of the vocabulary.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), docs["lang"].alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.empty((0, 0))
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, FIT_DOCUMENTS / sizes[lang]))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000).select(
        "lang", "text"
    )
    pieces = spark.sparkContext.broadcast(vocabulary(model_file))
    unknown = max(pieces.value.values(), default=-1) + 1
    logs = np.full((unknown + 1, len(langs)), -np.log(unknown + 1))
    for _ in range(ROUNDS):
        now = spark.sparkContext.broadcast(logs)

        def expected(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            lattice = Lattice(pieces.value)
            for batch in batches:
                for lang, texts in batch.groupby("lang")["text"]:
                    counts = Counter(w for text in texts for w in words_in(text))
                    k = langs.index(lang)
                    total = lattice.expected(counts, lattice.weights(now.value[:, [k]]))
                    seen = np.flatnonzero(total)
                    yield pd.DataFrame({"lang": k, "piece": seen, "n": total[seen]})

        found = (
            sample.mapInPandas(expected, "lang int, piece int, n double")
            .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        )
        counts = np.zeros_like(logs)
        counts[found["piece"], found["lang"]] = found["n"]
        everywhere = counts.sum(1, keepdims=True) + 0.01
        mixture = counts + PRIOR * everywhere / everywhere.sum()
        logs = np.log(mixture / mixture.sum(0))
    return langs, logs


def detect_languages(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of each row of docs.

    The language is that under which the whole text is likeliest, the sum over all segmentations
    of the product of its pieces; the score is its probability if all are equally common.  Ties
    go to the first in the alphabet.  A text that is null or has no letter, and any text if there
    is nothing to learn from, is `und` with score 0.  Repeated rows are judged each; an empty
    table gives no rows; other columns of docs are left out.  A null doc_id is not held out.

    Pieces never span words, so the sum over the segmentations of a text is the product of those
    of its words: a word is computed once for as long as a task remembers it.
    """
    langs, logs = fit(docs, model_file)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((vocabulary(model_file), logs) if langs else None)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, logs = model.value if langs else ({}, np.empty((1, 0)))
        lattice, kept = Lattice(pieces), 200_000
        weights = lattice.weights(logs)
        index: dict[bytes, int] = {}
        scores = np.empty((0, len(langs)))
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                texts = [words_in(t) if langs and t else [] for t in part["text"]]
                long = [[w for w in words if is_long(w)] for words in texts]
                texts = [[w for w in words if not is_long(w)] if own else words for words, own in zip(texts, long)]
                if len(index) > kept:
                    index, scores = {}, scores[:0]
                new = list({w for words in texts for w in words}.difference(index))
                index.update(zip(new, range(len(index), len(index) + len(new))))
                scores = np.concatenate([scores, *_scored(lattice, new, weights)])
                names, values = [], []
                for text, words, own in zip(part["text"], texts, long):
                    if not (words or own) or not any(map(str.isalpha, text)):
                        names.append(UNDETERMINED)
                        values.append(0.0)
                        continue
                    total = scores[np.fromiter(map(index.__getitem__, words), np.int64, len(words))].sum(0)
                    for word in own:
                        total += lattice.score_long(word, weights)
                    best = int(total.argmax())
                    names.append(langs[best])
                    values.append(float(1 / np.exp(total - total[best]).sum()))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64"), "held_out": part["held_out"],
                    "lang_pred": names, "score": values,
                })

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"].alias("text")
    ).mapInPandas(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def _scored(lattice: Lattice, words: list[bytes], weights: np.ndarray) -> Iterable[np.ndarray]:
    at_once = max(1, AT_ONCE // max(1, weights.shape[1]))
    for i in range(0, len(words), at_once):
        yield lattice.score(words[i : i + at_once], weights)
