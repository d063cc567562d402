"""Removal of long byte strings that occur earlier in the corpus.

The strings are the suffixes of the corpus cut at LENGTH bytes.  Sorted, equal ones form a run,
and a string is to go unless it is the earliest of its run.  A sort of every suffix would move
over a hundred bytes for each byte of text, so the suffixes are first dealt out by their
minimiser, the least hash of the K-grams in it, which equal strings share; strings that follow
each other share it too, so they travel as one stretch.  Stretches with a minimiser of their own
are unique and go no further.  Equal stretches are one run from end to end, of which only the
place of the earliest is kept.  What is left are distinct stretches with one minimiser: only
they are expanded into an index, which holds the strings in runs, each with the place of its
earliest, and are streamed through it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import mixed, stage, window_sums

#: Bytes of a string that must occur earlier, and of the pieces that minimisers are chosen from.
LENGTH, K = 100, 32
#: Stretches of one minimiser that one task indexes; of more, the strings are dealt out singly.
HOT = 20_000
#: Texts that a task works on at a time.
BATCH = 2_000

_CELL = "kind int, key long, context long, doc_id long, at long, tag int, strings int"


def stretches(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, hash, start and number of strings of each stretch of a text."""
    empty = np.empty(0, np.uint64)
    if len(codes) < LENGTH:
        return empty, empty, empty.astype(np.int64), empty.astype(np.int64)
    sums, factors = window_sums(codes)
    with np.errstate(over="ignore"):
        grams = least = mixed((sums[K:] - sums[:-K]) * factors[: len(codes) - K + 1])
        span, wanted = 1, LENGTH - K + 1
        while 2 * span <= wanted:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < wanted:
            least = np.minimum(least[: span - wanted], least[wanted - span :])
        # A stretch ends where another hash is the least, and where its first place is passed, so
        # that no two strings of one stretch are equal, also in a text of one letter.
        new = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new]))
        counts = np.diff(np.append(starts, len(least)))
        ends = starts + counts + LENGTH - 1
        contexts = mixed((sums[ends] - sums[starts]) * factors[starts] + counts.astype(np.uint64))
    return least[starts], contexts, starts, counts


def string_hashes(codes: np.ndarray) -> np.ndarray:
    """The hash of each string of LENGTH bytes."""
    sums, factors = window_sums(codes)
    with np.errstate(over="ignore"):
        return mixed((sums[LENGTH:] - sums[:-LENGTH]) * factors[: len(codes) - LENGTH + 1])


class RunIndex:
    """The strings of some stretches, sorted into runs of equal ones, with the earliest of each."""

    def __init__(self, hashes: np.ndarray, docs: np.ndarray, at: np.ndarray) -> None:
        order = np.lexsort((at, docs, hashes))
        heads = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
        self.runs = hashes[order][heads]
        self.doc, self.at = docs[order][heads], at[order][heads]

    def occur_earlier(self, hashes: np.ndarray, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each string has an equal one before it."""
        run = np.searchsorted(self.runs, hashes)
        return (self.doc[run] < docs) | ((self.doc[run] == docs) & (self.at[run] < at))


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, tag and text; the tag tells apart texts of one doc_id."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.hash(text).alias("tag"), text.alias("text"))


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The stretches of the texts: kind 0, or 1 if an earlier one of the batch is equal."""
    for batch in batches:
        for at in range(0, len(batch), BATCH):
            part = batch.iloc[at : at + BATCH].sort_values(["doc_id", "tag"])
            found = [stretches(np.frombuffer(text.encode(), np.uint8)) for text in part["text"]]
            sizes = [len(x[0]) for x in found]
            rows = pd.DataFrame({
                "kind": np.int32(0),
                "key": np.concatenate([x[0] for x in found]).view(np.int64),
                "context": np.concatenate([x[1] for x in found]).view(np.int64),
                "doc_id": np.repeat(part["doc_id"].to_numpy(np.int64), sizes),
                "at": np.concatenate([x[2] for x in found]),
                "tag": np.repeat(part["tag"].to_numpy(np.int32), sizes),
                "strings": np.concatenate([x[3] for x in found]).astype(np.int32),
            })
            # Equal rows of one doc_id are at one place, and none is before the other.
            first = rows.groupby(["key", "context"], sort=False)[["doc_id", "at", "tag"]].transform("first")
            rows["kind"] = (
                (first["doc_id"] != rows["doc_id"]) | (first["at"] != rows["at"]) | (first["tag"] != rows["tag"])
            ).astype(np.int32)
            yield rows


def _expanded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the wanted stretches of each text, or for hot minimisers the strings' hashes."""
    for batch in batches:
        for at in range(0, len(batch), BATCH // 10):
            out = []
            for row in batch.iloc[at : at + BATCH // 10].itertuples(index=False):
                data = row.text.encode()
                for want in row.wanted:
                    start, strings = want["at"], want["strings"]
                    part = data[start : start + strings + LENGTH - 1]
                    hashes = string_hashes(np.frombuffer(part, np.uint8)).view(np.int64) if want["hot"] else None
                    out.append((want["key"], row.doc_id, start, row.tag, None if want["hot"] else part, hashes))
            yield pd.DataFrame(out, columns=["key", "doc_id", "at", "tag", "bytes", "hashes"])


def _marked(docs: np.ndarray, at: np.ndarray, tags: np.ndarray) -> pd.DataFrame:
    """Strings that go, as stretches of strings that follow each other."""
    order = np.lexsort((at, tags, docs))
    docs, at, tags = docs[order], at[order], tags[order]
    new = np.ones(len(at), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (tags[1:] != tags[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    return pd.DataFrame({
        "doc_id": docs[heads], "at": at[heads], "tag": tags[heads],
        "strings": np.diff(np.append(heads, len(at))).astype(np.int32),
    })


def _indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The strings that occur earlier in another stretch of their minimiser; input sorted by key."""
    held: list[pd.DataFrame] = []

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        per = [string_hashes(np.frombuffer(x, np.uint8)) for x in rows["bytes"]]
        sizes = np.array([len(x) for x in per])
        with np.errstate(over="ignore"):
            key = mixed(np.repeat(rows["key"].to_numpy(np.int64).view(np.uint64), sizes))
            hashes = mixed(np.concatenate(per) + key)
        docs = np.repeat(rows["doc_id"].to_numpy(np.int64), sizes)
        at = np.repeat(rows["at"].to_numpy(np.int64), sizes) + (
            np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        )
        tags = np.repeat(rows["tag"].to_numpy(np.int32), sizes)
        gone = RunIndex(hashes, docs, at).occur_earlier(hashes, docs, at)
        return _marked(docs[gone], at[gone], tags[gone])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= HOT:
            rows = pd.concat(held)
            whole = rows["key"] != rows["key"].iloc[-1]
            if whole.any():
                yield judge(rows[whole])
            held = [rows[~whole]]
    if held and sum(map(len, held)):
        yield judge(pd.concat(held))


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), BATCH // 10):
            out = []
            for row in batch.iloc[at : at + BATCH // 10].itertuples(index=False):
                data = row.text.encode()
                starts, ends = [], []
                if row.marks is not None and len(row.marks):
                    for start, strings in sorted((m["at"], m["strings"]) for m in row.marks):
                        end = start + strings + LENGTH - 1
                        if starts and start <= ends[-1]:
                            ends[-1] = max(ends[-1], end)
                        else:
                            starts.append(start)
                            ends.append(end)
                kept = b"".join(data[a:b] for a, b in zip([0, *ends], [*starts, len(data)]))
                doc_id = None if row.no_id else row.doc_id
                out.append((doc_id, len(data), [{"start": a, "end": b} for a, b in zip(starts, ends)], kept))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (start, end) removed and kept bytes of each row of docs.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document of
    smaller doc_id, or earlier in the same one; overlapping ones count, and all is judged on the
    input.  The texts are their UTF-8 bytes, so a character may be cut apart, and no string spans
    two texts.  A null or short text keeps all.  A null doc_id is before all others.  Of different
    texts with one doc_id, equal strings at one start count by a checksum of the text; rows equal
    in both are at one place, and none is before the other.  An empty table gives no rows; other
    columns of docs are left out.

    Equal strings are found by 64-bit hashes of the minimiser and of the string together.
    """
    lowest = -(1 << 63)
    texts = _identified(docs).select(
        F.coalesce("doc_id", F.lit(lowest)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "tag", "text"
    )
    cells = texts.select("doc_id", "tag", "text").mapInPandas(_cells, _CELL)
    # Stretches that go already are dealt out by their own hash and are each alone.
    by_key = Window.partitionBy("kind", "group")
    by_context = Window.partitionBy("kind", "group", "context").orderBy("doc_id", "at", "tag")
    grouped = stage(
        cells.withColumn(
            "group", F.when(F.col("kind") == 0, F.col("key")).otherwise(F.xxhash64("doc_id", "at", "tag"))
        )
        .select(
            "*",
            F.count("*").over(by_key).alias("n"),
            (F.min("context").over(by_key) != F.max("context").over(by_key)).alias("several"),
        )
        .withColumn("first", F.rank().over(by_context) == 1)
        .where("kind = 1 OR NOT first OR several")
        .select(
            (F.col("kind") + (~F.col("first")).cast("int") > 0).alias("gone"),
            "key", "doc_id", "at", "tag", "strings", (F.col("n") > hot).alias("hot"),
        ),
        "stretches",
    )
    wanted = (
        grouped.where("NOT gone")
        .groupBy("doc_id", "tag")
        .agg(F.collect_set(F.struct("key", "at", "strings", "hot")).alias("wanted"))
    )
    expanded = stage(
        texts.select("doc_id", "tag", "text").join(wanted, ["doc_id", "tag"]).mapInPandas(
            _expanded, "key long, doc_id long, at long, tag int, bytes binary, hashes array<long>"
        ),
        "expanded",
    )
    tiles = expanded.where("bytes IS NOT NULL").select("key", "doc_id", "at", "tag", "bytes")
    found = tiles.repartition("key").sortWithinPartitions("key").mapInPandas(
        _indexed, "doc_id long, at long, tag int, strings int"
    )
    singles = expanded.where("hashes IS NOT NULL").select(
        "key", "doc_id", "tag", "at", F.posexplode("hashes").alias("i", "hash")
    ).select("key", "hash", "doc_id", (F.col("at") + F.col("i")).alias("at"), "tag")
    earliest = singles.groupBy("key", "hash").agg(F.min(F.struct("doc_id", "at")).alias("earliest"))
    found_hot = (
        singles.join(earliest, ["key", "hash"])
        .where(F.col("earliest") < F.struct("doc_id", "at"))
        .select("doc_id", "at", "tag", F.lit(1).alias("strings"))
    )
    marks = (
        grouped.where("gone").select("doc_id", "at", "tag", "strings")
        .unionByName(found).unionByName(found_hot)
        .groupBy("doc_id", "tag")
        .agg(F.collect_set(F.struct("at", "strings")).alias("marks"))
    )
    return texts.join(marks, ["doc_id", "tag"], "left").mapInPandas(
        _removed, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )
