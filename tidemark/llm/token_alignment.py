"""Where the tokens of two tokenizers end together, and how often each pair of ids does so corpus-wide."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stage

#: Parts into which the id pairs are dealt, by the lowest bits of the B id.
RADIXES = 16
#: Links after which a task writes its runs.
RUN_LINKS = 1 << 21
#: Runs merged at a time, about; a merge reads a block of each.
FAN_IN = 64
#: Pairs of a block.
BLOCK = 4096
#: Bits of a document's number within a run.
DOC_BITS = 22
#: Documents of one batch that a task returns.
BATCH = 1000


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, the other way round.

    Printable bytes stand for themselves, the others for the characters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {chr(byte if byte in plain else next(others)): byte for byte in range(256)}


class Tokenizers:
    """Both tokenizers, with the bytes and the written form of each of their ids.

    A's vocabulary is handed to tiktoken, which encodes four times as fast as the library whose
    file it is: there the ids of a byte-level BPE are the order of its merges (checked), so that
    merging by least id is merging in that order.
    """

    def __init__(self, a_file: str, b_file: str, pattern: str) -> None:
        with open(a_file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        code, vocabulary = byte_level(), model["vocab"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if [vocabulary[t] for t in merged] != sorted({vocabulary[t] for t in merged}):
            raise ValueError(f"the ids of {a_file} are not the order of its merges")
        # Special tokens are no merges; an id without a token has no bytes.
        ranks = {bytes(map(code.__getitem__, t)): vocabulary[t] for t in {*code, *merged}}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        n = max(vocabulary.values()) + 1
        self.a_bytes = [b""] * n
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_length = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], np.int64)
        #: Of A and B each id with a comma, then each with what ends its part of a group.
        self.written = [
            b"%d%s" % (i, end) for size, last in ((n, b"|"), (len(self.b_bytes), b";"))
            for end in (b",", last) for i in range(size)
        ]

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of each text by A and by B; None where one of them does not keep its bytes."""
        filled = [t for t in texts if t]
        by_b = iter(self.b.encode(filled, num_threads=1))
        for text in texts:
            if not text:
                yield None
                continue
            a, b, whole = self.a.encode_ordinary(" " + text), next(by_b), b" " + text.encode()
            same = (
                b"".join(map(self.a_bytes.__getitem__, a)) == whole
                and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            )
            yield (np.array(a, np.int64), np.array(b, np.int64)) if same else None

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of A and of B that end together: the last ones of each group."""
        _, of_a, of_b = np.intersect1d(
            np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b]), assume_unique=True, return_indices=True
        )
        return of_a, of_b

    def digest(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> str:
        """The SHA-256 of the groups, written `a1,a2|b1;a3|b2,b3`."""
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[of_a], last_b[of_b] = True, True
        # A token of A stands behind the tokens of B of the groups before its own, and one of B
        # behind those of A up to its own group's.
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], of_b + 1])
        at = np.empty(len(a) + len(b), np.int64)
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        at[np.arange(len(a)) + before_b[group_a]] = a + n_a * last_a
        at[np.arange(len(b)) + of_a[group_b] + 1] = 2 * n_a + b + n_b * last_b
        return hashlib.sha256(b"".join(map(self.written.__getitem__, at.tolist()))[:-1]).hexdigest()


@lru_cache(maxsize=1)
def both(a_file: str, b_file: str, pattern: str) -> Tokenizers:
    """The tokenizers, kept between the tasks of a Python worker."""
    return Tokenizers(a_file, b_file, pattern)


# -- runs: sorted arrays, compressed one after the other


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame: their number, lengths and item sizes, then their bytes."""
    head = np.array([len(arrays), *[x for array in arrays for x in (len(array), array.dtype.itemsize)]], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *[a.tobytes() for a in arrays]]))


def unpack(run: bytes) -> list[np.ndarray]:
    """The arrays of `pack`, as unsigned integers."""
    data = zstandard.ZstdDecompressor().decompress(run)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    shapes, at, arrays = np.frombuffer(data, "<i8", 2 * n, 8).reshape(n, 2), 8 + 16 * n, []
    for length, width in shapes.tolist():
        arrays.append(np.frombuffer(data, f"<u{width}", length, at))
        at += length * width
    return arrays


class CountRun:
    """A run of (pair, count) in the order of pairs, read block by block out of its zstd frame."""

    def __init__(self, run: bytes) -> None:
        self.source = zstandard.ZstdDecompressor().stream_reader(run)
        self.advance()

    def advance(self) -> bool:
        """Whether there is another block, which is then the current one."""
        block = np.frombuffer(self.source.read(16 * BLOCK), "<u8").reshape(-1, 2)
        self.pairs, self.counts = block[:, 0], block[:, 1]
        return len(block) > 0


def pack_counts(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.stack([pairs, counts], 1).astype("<u8").tobytes())


def summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, in order, with the sum of its counts."""
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    starts = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] + np.uint64(1)))
    return pairs[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def merge(runs: list[bytes]) -> bytes:
    """One run of several, with the counts of equal pairs added.

    A heap holds the last pair of each run's current block.  What is not above the smallest of
    these is complete: no run has such a pair in a later block.
    """
    opened = [run for run in map(CountRun, runs) if len(run.pairs)]
    heap = [(int(run.pairs[-1]), i) for i, run in enumerate(opened)]
    heapq.heapify(heap)
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    while heap:
        bound, complete = heap[0][0], []
        for _, i in heap:
            run = opened[i]
            cut = int(np.searchsorted(run.pairs, np.uint64(bound), "right"))
            complete.append((run.pairs[:cut], run.counts[:cut]))
            run.pairs, run.counts = run.pairs[cut:], run.counts[cut:]
        out.append(summed(*map(np.concatenate, zip(*complete))))
        while heap and not len(opened[heap[0][1]].pairs):
            run, i = opened[heap[0][1]], heap[0][1]
            if run.advance():
                heapq.heapreplace(heap, (int(run.pairs[-1]), i))
            else:
                heapq.heappop(heap)
    return pack_counts(*map(np.concatenate, zip(*out)))


def written_runs(links: list[np.ndarray], n_a: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Of each radix the run of (pair, count) and the run of (pair, document, count).

    links has the pairs of each document; a pair is its B id times the size of A plus its A id,
    so that the order of pairs is that of B ids first.
    """
    keys = np.concatenate([pairs << DOC_BITS | doc for doc, pairs in enumerate(links)])
    keys, counts = np.unique(keys, return_counts=True)
    pairs, docs = keys >> DOC_BITS, keys & ((1 << DOC_BITS) - 1)
    radix = (pairs // n_a % RADIXES).astype(np.uint8)
    order = np.argsort(radix, kind="stable")
    for r, part in enumerate(np.split(order, np.searchsorted(radix[order], np.arange(1, RADIXES)))):
        if not len(part):
            continue
        own, n = pairs[part], counts[part]
        starts = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
        totals = np.add.reduceat(n, starts)
        of_pair = np.diff(starts, append=len(own))
        yield r, pack_counts(own[starts], totals), pack(
            own[starts].astype("<u8"), of_pair.astype("<u4"), docs[part].astype("<u4"), n.astype("<u4")
        )


def align(
    docs: DataFrame, a_file: str, b_file: str, pattern: str, run_links: int = RUN_LINKS, fan_in: int = FAN_IN
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of docs.

    A (a byte-level BPE file of the tokenizers library, whose pieces are the matches of pattern)
    encodes a space and the text, B (a sentencepiece model, which adds the space) the text, both
    without special tokens.  Where a
    token of A and one of B end at the same byte, a group ends and these two tokens are linked.
    The count of a link is how many links of the corpus have its pair of ids; it is a best one if
    no other pair with its B id has a higher count.

    A null or empty text, or one whose bytes either tokenizer changes, has no tokens: zeros and
    an empty digest.  Repeated rows count each, also with one or no doc_id; an empty table gives
    no rows; other columns are left out.  Both files must be at the same place on every executor.

    Counting is external: tasks write their links as sorted runs in zstd, dealt out by the low
    bits of the B id, one of (pair, count) and one of (pair, document, count).  The former are
    merged by heaps, some `fan_in` at a time, round by round until each radix has one; a hot pair
    is one record of a run, so no merge grows with the number of documents.  The order of these
    runs is by B first, so the highest count of each B id is at hand when a radix has been read,
    and the counts stream back over the latter runs, which are dealt out in shares of about
    `fan_in` runs, each with a copy of the counts of its radix.  A run's size is bounded by
    run_links, that of counts by the pairs of a radix that exist.
    """
    out = pa.schema([
        ("run", pa.int64()), ("doc", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
        ("radix", pa.int32()), ("counts", pa.binary()), ("links", pa.binary()),
    ])
    nothing = np.zeros(0, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = both(a_file, b_file, pattern)
        n_a = len(own.a_bytes)
        run, pending, held = TaskContext.get().partitionId() << 33, [], 0

        def rows(columns: dict) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns.get(f.name, [None] * n), f.type) for f in out], schema=out
            )

        def runs() -> pa.RecordBatch:
            found = list(written_runs(pending, n_a))
            return rows({
                "run": [run] * len(found), "radix": [r for r, _, _ in found],
                "counts": [c for _, c, _ in found], "links": [x for _, _, x in found],
            })

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                columns: dict[str, list] = {f.name: [] for f in list(out)[:8]}
                written = []
                for doc_id, ids in zip(part["doc_id"].to_pylist(), own.encode(part["text"].to_pylist())):
                    a, b = ids or (nothing, nothing)
                    of_a, of_b = own.groups(a, b)
                    digest = own.digest(a, b, of_a, of_b) if len(a) else ""
                    row = run, len(pending), doc_id, len(a), len(b), len(of_a), len(of_a), digest
                    for column, value in zip(columns.values(), row):
                        column.append(value)
                    pending.append(b[of_b] * n_a + a[of_a])
                    held += len(of_a)
                    if held >= run_links or len(pending) >> DOC_BITS:
                        written.append(runs())
                        run, pending, held = run + 1, [], 0
                yield rows(columns)
                yield from written
        if pending:
            yield runs()

    ddl = (
        "run long, doc long, doc_id long, n_a long, n_b long, n_groups long, n_links long,"
        " groups_sha256 string, radix int, counts binary, links binary"
    )
    encoded = stage(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(encode, ddl), "runs")
    of_docs = encoded.where("doc IS NOT NULL").drop("radix", "counts", "links")
    runs = encoded.where("radix IS NOT NULL")
    n_runs = runs.select("run").distinct().count()
    totals = _merged(runs.select("run", "radix", "counts"), n_runs, fan_in)
    shares = max(1, -(-n_runs // fan_in))
    given = totals.select(
        "radix", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        F.lit(None).cast("long").alias("run"), F.col("counts").alias("data"),
    ).unionByName(runs.select("radix", _dealt("run", shares).alias("share"), "run", F.col("links").alias("data")))
    back = (
        given.repartition(RADIXES * shares, "radix", "share")
        .sortWithinPartitions("radix", "share", F.col("run").asc_nulls_first())
        .mapInArrow(_contributions(a_file, b_file, pattern), "run long, doc long, n_best long, count_sum long")
        .groupBy("run", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return of_docs.join(back, ["run", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )


def _dealt(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _merged(runs: DataFrame, n_runs: int, fan_in: int) -> DataFrame:
    """radix and the one run of counts left of it."""

    def merged(group: pa.Table) -> pa.Table:
        return pa.table({
            "run": pa.array(group["share"][:1].to_pylist(), pa.int64()),
            "radix": pa.array(group["radix"][:1].to_pylist(), pa.int32()),
            "counts": pa.array([merge(group["counts"].to_pylist())], pa.binary()),
        })

    while True:
        n_runs = -(-n_runs // fan_in) or 1
        # Another hash in each round, or those that met once would meet again.
        shares = runs.withColumn("share", F.pmod(F.xxhash64("run", F.lit(n_runs)), F.lit(n_runs)))
        runs = stage(shares.groupBy("radix", "share").applyInArrow(merged, "run long, radix int, counts binary"), "counts")
        if n_runs == 1:
            return runs.select("radix", "counts")


def _contributions(a_file: str, b_file: str, pattern: str):
    """What the links of each document are worth, radix by radix: the counts come before the runs."""
    schema = pa.schema([(name, pa.int64()) for name in ("run", "doc", "n_best", "count_sum")])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_a = np.uint64(len(both(a_file, b_file, pattern).a_bytes))
        pairs = counts = best = None
        for batch in batches:
            for run, data in zip(batch["run"].to_pylist(), batch["data"]):
                if run is None:
                    table = np.frombuffer(zstandard.ZstdDecompressor().stream_reader(data.as_py()).read(), "<u8").reshape(-1, 2)
                    pairs, counts = table[:, 0], table[:, 1]
                    side = pairs // n_a
                    starts = np.flatnonzero(np.diff(side, prepend=side[:1] + np.uint64(1)))
                    highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(starts, append=len(side)))
                    best = counts == highest
                    continue
                own, of_pair, docs, n = unpack(data.as_py())
                at = np.repeat(np.searchsorted(pairs, own), of_pair)
                size = int(docs.max()) + 1
                # Sums of doubles would round, so the counts are added as integers.
                count_sum, n_best = np.zeros(size, np.int64), np.zeros(size, np.int64)
                np.add.at(count_sum, docs, counts[at].astype(np.int64) * n)
                np.add.at(n_best, docs, best[at] * n.astype(np.int64))
                held = np.flatnonzero(count_sum)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.full(len(held), run), held, n_best[held], count_sum[held])], schema=schema
                )

    return back
