"""Pieces that several operators share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.folders import shared_folder

#: What separates words: the ASCII white space that bytes.split() splits at.
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"

_staged: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used; `release` deletes it."""
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}/{name}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """df, computed once: written as Parquet to the shared folder and read again.

    Survives lost executors, unlike a cache, and cuts the lineage.  `release` deletes the files.
    What df was shuffled through is not needed any more; a collection of garbage in the driver
    makes Spark delete it now rather than some time later.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes what `stage` has written; to be called once the results have been consumed."""
    jvm = spark._jvm
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop()).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows, and bytes of their files, of a side that is broadcast whatever Spark estimates; with more of
#: either it chooses by itself.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 1 << 25


def fits_broadcast(staged: DataFrame) -> bool:
    """Whether what `stage` has written last may be broadcast."""
    path = staged.sparkSession._jvm.org.apache.hadoop.fs.Path(_staged[-1])
    size = path.getFileSystem(staged.sparkSession._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return size <= BROADCAST_BYTES and staged.count() <= BROADCAST_ROWS


def small(df: DataFrame) -> DataFrame:
    """df, staged, to be broadcast if it has at most BROADCAST_ROWS rows in BROADCAST_BYTES."""
    df = stage(df, "small")
    return F.broadcast(df) if fits_broadcast(df) else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.coalesce(
        F.filter(F.split(text, BETWEEN_WORDS), lambda word: word != ""),
        F.array().cast("array<string>"),
    )


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64."""
    with np.errstate(over="ignore"):
        hashes = (hashes ^ (hashes >> np.uint64(32))) * _MIX[0]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX[1]
        return hashes ^ (hashes >> np.uint64(32))


#: Bytes hashed at a time.
BLOCK = 1 << 20
#: A-Z to lower case, and all that separates words to a space.
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\f\r", b"abcdefghijklmnopqrstuvwxyz" + b" " * 5
)
_SPACE = ord(" ")


_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


@lru_cache(maxsize=1)
def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, and the powers of the base and of its inverse."""
    n = BLOCK + 1
    return mixed(np.arange(1, 257, dtype=np.uint64)), _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def window_sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over the bytes, and the factors that bring a part to its start.

    The hash of codes[a:b] is mixed((sums[b] - sums[a]) * factors[a]); it depends on its bytes
    alone, for parts of one length.
    """
    values, powers, inverse = _hash_tables()
    n = len(codes)
    if n > len(powers):
        powers, inverse = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[codes] * powers[:n], out=sums[1:])
    return sums, inverse


def _block_word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of data begins, and its hash, which does not depend on its place."""
    codes = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(codes == _SPACE, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    sums, factors = window_sums(codes)
    with np.errstate(over="ignore"):
        return starts, mixed((sums[ends] - sums[starts]) * factors[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """Of each text the 64-bit hashes of its words in order, A-Z lower-cased.

    Many short texts are hashed at once, and a long one in blocks that are cut between words.
    """
    pending: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        lengths = np.array([len(x) + 1 for x in pending])
        starts, hashes = _block_word_hashes(b" ".join(pending))
        yield from np.split(hashes, np.searchsorted(starts, np.cumsum(lengths)[:-1]))

    for text in texts:
        data = text.encode().translate(_PLAIN) if text else b""
        if pending and size + len(data) > BLOCK:
            yield from flush()
            pending, size = [], 0
        if len(data) <= BLOCK:
            pending.append(data)
            size += len(data) + 1
            continue
        parts, at = [], 0
        while at < len(data):
            cut = data.rfind(b" ", at, at + BLOCK) if at + BLOCK < len(data) else len(data)
            if cut <= at:
                cut = data.find(b" ", at + BLOCK)
                cut = len(data) if cut < 0 else cut
            parts.append(_block_word_hashes(data[at:cut])[1])
            at = cut + 1
        yield np.concatenate(parts)
    if pending:
        yield from flush()


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the runs of `size` words; of fewer words, all as one."""
    k = min(len(words), size)
    if not k:
        return words
    with np.errstate(over="ignore"):
        factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
        total = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            total += words[j : len(words) - k + 1 + j] * factors[j]
        return np.unique(mixed(total))
