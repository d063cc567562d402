"""Byte-level BPE of whole texts, with long texts pre-tokenised in overlapping chunks."""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

#: Characters of a chunk, and those of the next one that it looks at too.
CHUNK, OVERLAP = 16_384, 1_024
#: Characters at the end of what a chunk sees, before which a match may look different in the
#: whole text: the longest ending after an apostrophe.
UNSURE = 3
#: Texts of one batch that a task returns.
BATCH = 400


class Codec:
    """Encodes pieces by the ranks of a file; pieces seen before come from a bounded store."""

    KEPT = 100_000

    def __init__(self, ranks_file: str, pattern: str) -> None:
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        # A piece is a match already, so the library is given a pattern that takes all of it.
        self.encoding = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}

    def encode(self, pieces: list[str]) -> bytes:
        """The ids of the pieces as little-endian unsigned 32-bit integers."""
        known = self.known
        if len(known) > self.KEPT:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = np.array(self.encoding.encode_ordinary(piece), "<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(ranks_file: str, pattern: str) -> Codec:
    """The codec of a file, kept between the tasks of a Python worker."""
    return Codec(ranks_file, pattern)


def boundaries(pattern: regex.Pattern, text: str, start: int) -> np.ndarray:
    """Where the matches in a chunk that begins at start end, as places in the whole text."""
    lengths = np.fromiter(map(len, pattern.findall(text)), np.int64)
    return start + np.cumsum(lengths)


def stitch(chunks: list[tuple[int, int, np.ndarray]], length: int) -> list[int] | None:
    """Ends of the matches in a whole text of that length, from (start, end, ends) of its chunks.

    How a match goes on depends on the text from its start alone.  So from the first place where
    a match ends in a chunk and in the one before it, both have the same matches, as far as the
    earlier one sees enough.  The later chunk is followed from there; its matches before that
    began inside one.  None if two chunks do not meet within their overlap.
    """
    merged: list[int] = chunks[0][2].tolist()
    sure = chunks[0][1] if chunks[0][1] == length else chunks[0][1] - UNSURE
    for start, end, ends in chunks[1:]:
        own = ends.tolist()
        places = set(own)
        at = bisect_right(merged, start)
        while at < len(merged) and merged[at] <= sure and merged[at] not in places:
            at += 1
        if at == len(merged) or merged[at] > sure:
            return None
        merged[at + 1 :] = own[bisect_left(own, merged[at]) + 1 :]
        sure = end if end == length else end - UNSURE
    return merged


def encode(docs: DataFrame, ranks_file: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of each row of docs.

    Every match of pattern is encoded by itself, as the tiktoken library would do, without
    special tokens.  With decoded, a column decoded has the bytes that the ids stand for.  A null
    or empty text has no tokens; repeated rows are encoded each, also of one or no doc_id; an
    empty table gives no rows.  Other columns of docs are left out.  ranks_file must be at the
    same place on every executor.

    A text of up to CHUNK + OVERLAP characters is one chunk, encoded where it is read.  Longer
    ones are cut into overlapping chunks, which are dealt out and pre-tokenised in parallel; the
    chunks of one text are then brought together, stitched, and the pieces encoded.  Where two
    chunks do not meet, in a run of over a thousand characters without a boundary, that text is
    pre-tokenised whole.
    """
    columns = "doc_id long, n_tokens long, ids binary" + (", decoded binary" if decoded else "")

    def encoded(doc_ids: list, pieces: Iterator[list[str]]) -> pd.DataFrame:
        own = codec(ranks_file, pattern)
        ids = [own.encode(p) for p in pieces]
        out = pd.DataFrame({
            "doc_id": pd.array(doc_ids, "Int64"), "n_tokens": [len(x) // 4 for x in ids], "ids": ids,
        })
        return out.assign(decoded=[own.decode(x) for x in ids]) if decoded else out

    def encode_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        findall = codec(ranks_file, pattern).pattern.findall
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                yield encoded(
                    [None if pd.isna(x) else int(x) for x in part["doc_id"]], map(findall, part["text"])
                )

    def pre_tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_file, pattern).pattern
        for batch in batches:
            yield batch.assign(ends=[
                boundaries(own, text, k * CHUNK).tobytes() for text, k in zip(batch["text"], batch["k"])
            ])

    def join_chunks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        chunks = [
            (k * CHUNK, k * CHUNK + len(text), np.frombuffer(ends, np.int64))
            for k, text, ends in zip(group["k"], group["text"], group["ends"])
        ]
        text = "".join(text[:CHUNK] for text in group["text"].iloc[:-1]) + group["text"].iloc[-1]
        ends = stitch(chunks, len(text))
        if ends is None:
            pieces = codec(ranks_file, pattern).pattern.findall(text)
        else:
            pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
        doc_id = group["doc_id"].iloc[0]
        return encoded([None if pd.isna(doc_id) else int(doc_id)], iter([pieces]))

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    length = F.char_length("text")
    short = texts.where(length <= CHUNK + OVERLAP).mapInPandas(encode_texts, columns)
    chunks = (
        texts.where(length > CHUNK + OVERLAP)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.ceil((length - OVERLAP) / CHUNK).cast("int") - 1)))
        .select("row", "doc_id", "k", F.substring("text", F.col("k") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("text"))
    )
    long = (
        chunks.repartition("row", "k")
        .mapInPandas(pre_tokenise, "row long, doc_id long, k int, text string, ends binary")
        .groupBy("row")
        .applyInPandas(join_chunks, columns)
    )
    return short.unionByName(long)


def decode(encoded: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id and decoded of each row of encoded: the raw bytes of its ids, joined.

    Null ids give no bytes.
    """

    def decode_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_file, pattern)
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "decoded": [own.decode(x or b"") for x in batch["ids"]],
            })

    return encoded.select("doc_id", "ids").mapInPandas(decode_ids, "doc_id long, decoded binary")
