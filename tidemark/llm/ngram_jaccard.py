"""Documents linked by the Jaccard similarity of their sets of word shingles."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import mixed, shingle_set, small, stage, word_hashes
from tidemark.llm.components import components

#: Words of a shingle, and the similarity of a link as a fraction.
WORDS, SIMILAR, OF = 5, 75, 100
#: Counters of the frequency sketch of shingles, and the bits of a hash that choose one.
SLOT_BITS = 22
SLOTS = 1 << SLOT_BITS
#: Rows in which a task hands its sketch on.
SEGMENTS = 64
#: Members of a tile up to which all its pairs become candidates at once.
SMALL = 12
#: Texts, or pairs, that a task works on at a time.
BATCH = 1_000
#: Rows of a tile that a task holds at a time in the first round.
CHUNK = 20_000
#: Members of a tile that meet each other in one task of the second round; of a larger tile every
#: two blocks of about as many meet.
BLOCK = 2_000
#: Keys of a document's tiles, the smallest first, that tell whether a pair has met before.
FIRST_KEYS = 8
#: Nodes from here on stand for documents without an id.
NAMELESS = 1 << 62

_NO_SHINGLES = np.empty(0, np.uint64)


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix(n: int) -> tuple[int, int]:
    """How many shingles of a set of n deal it to tiles, and how many more, as reserve.

    Two sets of n and m shingles have 3 (n + m) / 7 or more in common to be similar, and so at
    least 3 n / 4; in whatever order all shingles are sorted, the first n - ceil(3 n / 4) + 1 of
    both then share one.  With the reserve that also holds in the order that puts the shingles of
    large tiles last, for sets with no more of these than the reserve.
    """
    needed = n - -(-SIMILAR * n // OF) + 1
    return needed, needed // 4


def _sets(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[np.ndarray], np.ndarray]]:
    """Parts of a batch, the shingle set of each text, and a hash of each set."""
    for at in range(0, len(batch), BATCH):
        part = batch.iloc[at : at + BATCH]
        sets = [shingle_set(words, WORDS) for words in word_hashes(list(part["text"]))]
        with np.errstate(over="ignore"):
            sums = np.array([s.sum() + mixed(s ^ np.uint64(len(s))).sum() for s in sets], np.uint64)
        yield part, sets, mixed(sums).view(np.int64)


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, tag, size, hash and bitmap of each set, and at the end the frequencies of the task.

    These come in segments, whose number stands in for the hash.
    """
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for part, sets, hashes in _sets(batch):
            shingles = np.concatenate([_NO_SHINGLES, *sets])
            counts += np.bincount(_slots(shingles), minlength=SLOTS)
            yield pd.DataFrame({
                "doc_id": part["doc_id"].astype("Int64"), "tag": part["tag"], "n": [len(s) for s in sets],
                "c": hashes, "bits": [signature(s).tobytes() for s in sets], "counts": None,
            })
    for segment, own in enumerate(counts.reshape(SEGMENTS, -1)):
        yield pd.DataFrame({
            "doc_id": pd.array([None], "Int64"), "tag": 0, "n": -1, "c": segment, "bits": None,
            "counts": [_packed(own)],
        })


def _packed(counts: np.ndarray) -> bytes:
    """Counters, most of them small, in few bytes."""
    return zlib.compress(counts.astype(np.int64).tobytes(), 1)


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), np.int64)


def _prefix_rows(levels: Broadcast):
    """Of each set the shingles that deal it to tiles, rare ones first.

    n is twice the size of the set, and one more where the shingle is of the reserve.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            for _, sets, hashes in _sets(batch):
                keys, owners, sizes = [], [], []
                for s, c in zip(sets, hashes.tolist()):
                    if not len(s) or c in seen:
                        continue
                    if len(seen) < 100_000:  # copies are joined later anyway
                        seen.add(c)
                    order = (levels.value[_slots(s)].astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6))
                    needed = prefix(len(s))[0]
                    k = min(len(s), sum(prefix(len(s))))
                    keys.append(np.partition(order, (needed - 1, k - 1))[:k])
                    owners.append(c)
                    sizes.append(2 * len(s) + (np.arange(k) >= needed))
                lengths = [len(k) for k in keys]
                yield pd.DataFrame({
                    "key": np.concatenate([_NO_SHINGLES, *keys]).view(np.int64),
                    "c": np.repeat(np.array(owners, np.int64), lengths),
                    "n": np.concatenate([np.empty(0, np.int32), *sizes]).astype(np.int32),
                })

    return rows


def _leaders(n: np.ndarray) -> np.ndarray:
    """For each of the sorted sizes the place of the smallest of its band."""
    leaders, at = np.zeros(len(n), np.int64), 0
    while at < len(n):
        end = int(np.searchsorted(n, n[at] * OF // SIMILAR, "right"))
        leaders[at:end] = at
        at = end
    return leaders


def _tile(c: np.ndarray, n: np.ndarray, part_of_large: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Candidate pairs of one tile, sorted by size, and whether some are left to a second look."""
    g = len(c)
    if g <= SMALL and not part_of_large:
        i, j = np.triu_indices(g, 1)
        near = OF * n[i] >= SIMILAR * n[j]
        return c[i[near]], c[j[near]], False
    # In each band of sizes all with the smallest, and each with the next in size.
    i = np.concatenate([_leaders(n), np.arange(g - 1)])
    j = np.concatenate([np.arange(g), np.arange(1, g)])
    near = (i != j) & (OF * n[i] >= SIMILAR * n[j])
    return c[i[near]], c[j[near]], True


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs (key null) and the members of tiles that need a second look.

    Input as of _prefix_rows, sorted by key, size and hash; spare marks members by their reserve.
    A tile of more than CHUNK rows comes in parts, each led by the leader of the last band so far
    and the last row.
    """
    def tiles(rows: pd.DataFrame, part_of_large: bool) -> pd.DataFrame:
        key, c, n, spare, old = (rows[x].to_numpy() for x in ("key", "c", "n", "spare", "old"))
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(heads, len(key)))
        two = heads[(sizes == 2) & (not part_of_large)]
        near = OF * n[two].astype(np.int64) >= SIMILAR * n[two + 1].astype(np.int64)
        firsts, seconds, members = [c[two[near]]], [c[two[near] + 1]], []
        others = (sizes > 2) | part_of_large
        for head, size in zip(heads[others].tolist(), sizes[others].tolist()):
            part = slice(head, head + size)
            a, b, more = _tile(c[part], n[part].astype(np.int64), part_of_large)
            firsts.append(a)
            seconds.append(b)
            if more:
                members.append(part)
        a, b = np.concatenate(firsts), np.concatenate(seconds)
        pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
        out = pairs[pairs["a"] != pairs["b"]].assign(key=pd.array([pd.NA], "Int64")[0], n=0, spare=False)
        out["key"] = out["key"].astype("Int64")
        if members:
            at = np.concatenate([np.arange(p.start, p.stop) for p in members])
            at = at[~old[at]]
            left = pd.DataFrame({"a": c[at], "b": c[at], "key": pd.array(key[at], "Int64"), "n": n[at], "spare": spare[at]})
            out = pd.concat([out, left])
        return out[["key", "a", "b", "n", "spare"]]

    batches = (batch.assign(n=batch["n"] // 2, spare=batch["n"] % 2 == 1) for batch in batches)
    for rows, part in _parts_of_tiles(batches):
        yield tiles(rows, part)


def signature(shingles: np.ndarray) -> np.ndarray:
    """A bitmap with the bit of each hash set: 4 to 8 bits for each shingle, a power of two."""
    width = max(64, 1 << (4 * len(shingles)).bit_length())
    bits = np.zeros(width, bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def overlap_bound(a: np.ndarray, n: int, b: np.ndarray, m: int) -> int:
    """The most shingles that sets of n and m can share, by the bits set in one bitmap only."""
    width = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, width)) for x in (a, b))
    only_a = int(np.bitwise_count(a & ~b).sum())
    only_b = int(np.bitwise_count(b & ~a).sum())
    return min(n - only_a, m - only_b)


def _similar(overlap, n, m):
    return OF * overlap >= SIMILAR * (n + m - overlap)


def _crossing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of members of one tile, one of them heavy, that the bitmaps do not tell apart.

    Input sorted by tile and blocks; only pairs of different components and near sizes are
    compared, each member with all others at once.  No pair leaves the task that the bitmaps
    exclude, or that has met in a tile of a smaller key, as far as FIRST_KEYS tell.
    """

    def compared(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        c, n, root, heavy, own_block = (rows[x].to_numpy() for x in ("c", "n", "root", "heavy", "own"))
        n = n.astype(np.int64)
        one_block = rows["low"].iloc[0] == rows["high"].iloc[0]
        key = rows["key"].iloc[0]
        before = np.full((len(c), FIRST_KEYS), key, np.int64)
        for at, keys in enumerate(rows["firsts"]):
            before[at, : len(keys)] = np.minimum(keys, key)
        widths = rows["bits"].map(len).to_numpy()
        for width in np.unique(widths):
            # Near sizes have bitmaps of one width, or one of twice the other.
            own, twice = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
            at = np.concatenate([own, twice])
            bits = np.zeros((len(at), width), np.uint8)
            bits[: len(own)] = np.frombuffer(b"".join(rows["bits"].iloc[own]), np.uint8).reshape(-1, width)
            if len(twice):
                wide = np.frombuffer(b"".join(rows["bits"].iloc[twice]), np.uint8).reshape(-1, 2, width)
                bits[len(own) :] = wide[:, 0] | wide[:, 1]
            bits = bits.view(np.uint64)
            for i in range(len(own)):
                rest = np.arange(i + 1, len(at))
                a, b = at[i], at[rest]
                near = (
                    (root[b] != root[a]) & (heavy[b] | heavy[a]) & (one_block | (own_block[b] != own_block[a]))
                    & (OF * np.minimum(n[a], n[b]) >= SIMILAR * np.maximum(n[a], n[b]))
                )
                rest, b = rest[near], b[near]
                if not len(rest):
                    continue
                both = np.bitwise_count(bits[i] & bits[rest]).sum(1, dtype=np.int64)
                only_a = np.bitwise_count(bits[i]).sum(dtype=np.int64) - both
                only_b = np.bitwise_count(bits[rest]).sum(1, dtype=np.int64) - both
                b = b[_similar(np.minimum(n[a] - only_a, n[b] - only_b), n[a], n[b])]
                mine = before[a][before[a] < key]
                if len(b) and len(mine):
                    b = b[~np.isin(before[b], mine).any(1)]
                yield np.full(len(b), c[a]), c[b]

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        found = [pair for _, part in rows.groupby(["key", "low", "high"], sort=False) for pair in compared(part)]
        a = np.concatenate([np.empty(0, np.int64), *[x for x, _ in found]])
        b = np.concatenate([np.empty(0, np.int64), *[y for _, y in found]])
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    for rows in _whole_groups(batches, ["key", "low", "high"]):
        yield pairs(rows)


def _blocks(members: DataFrame) -> DataFrame:
    """Each member of a tile of g rows once for every two blocks (low, high) that it belongs to."""
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("c"), blocks).cast("int")
    return (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other", "g")
    )


def _whole_groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The same rows, sorted by some columns, in frames that cut no group of these apart."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[by].iloc[-1]
        if held and (batch[by].iloc[0] == last).all() and (held[-1][by].iloc[-1] == last).all():
            held.append(batch)
            continue
        rows = pd.concat([*held, batch])
        whole = (rows[by] != last).any(axis=1).to_numpy()
        if whole.any():
            yield rows[whole]
        held = [rows[~whole]]
    if held:
        yield pd.concat(held)


def _parts_of_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Distinct rows in frames of whole tiles, or of one part of a tile of more than CHUNK rows.

    The column old marks the rows that a part repeats from the one before it.
    """
    held, large = None, False
    for batch in batches:
        if not len(batch):
            continue
        rows = batch.assign(old=False)
        if held is not None:
            rows = pd.concat([held, rows])
        rows = rows.drop_duplicates(["key", "c", "n"])
        if large:
            of_it = (rows["key"] == rows["key"].iloc[0]).to_numpy()
            yield rows[of_it], True
            large = bool(of_it.all())
            held = _led(rows) if large else None
            rows = rows[~of_it]
            if not len(rows):
                continue
        last = (rows["key"] == rows["key"].iloc[-1]).to_numpy()
        if not last.all():
            yield rows[~last], False
        held = rows[last]
        if len(held) > CHUNK:
            large = True
            yield held, True
            held = _led(held)
    if held is not None and not large:
        yield held, False


def _led(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the rows of a tile, sorted by size, the leader of the last band and the last one."""
    leader = int(_leaders(rows["n"].to_numpy().astype(np.int64))[-1])
    return rows.iloc[sorted({leader, len(rows) - 1})].assign(old=True)


def _bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = [
            _similar(overlap_bound(np.frombuffer(x, np.uint8), n, np.frombuffer(y, np.uint8), m), n, m)
            for x, n, y, m in zip(batch["bits_a"], batch["n_a"], batch["bits_b"], batch["n_b"])
        ]
        yield batch.loc[keep, ["a", "b"]]


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = []
        for x, y in zip(batch["shingles_a"], batch["shingles_b"]):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            keep.append(_similar(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)))
        yield batch.loc[keep, ["a", "b"]]


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, sets, hashes in _sets(batch):
            yield pd.DataFrame({"c": hashes, "shingles": [s.tobytes() for s in sets]})


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["text"]).alias("tag"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, own in zip(batch["c"].tolist(), batch["counts"]):
            totals[segment] = totals.get(segment, 0) + _unpacked(own)
    for segment, total in totals.items():
        yield pd.DataFrame({"c": [segment], "counts": [_packed(total)]})


def _levels(summaries: DataFrame) -> np.ndarray:
    """How far above the mean the counter of each slot is, in half doublings.

    The sketches of the tasks are added up segment by segment; one, of a fixed size, reaches the
    driver.
    """
    sketches = summaries.where("counts IS NOT NULL").select("c", "counts").repartition(SEGMENTS, "c")
    added = sketches.mapInPandas(_added, "c long, counts binary").collect()
    counts = np.concatenate([np.zeros(0), *[_unpacked(r["counts"]) for r in sorted(added, key=lambda r: r["c"])]])
    if not len(counts):
        counts = np.zeros(SLOTS)
    above = np.maximum(counts / max(counts.mean(), 1.0), 1.0)
    return np.minimum(np.log2(above) * 2, 63).astype(np.uint8)


def _bounded_pairs(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of set hashes that the bitmaps do not tell apart."""
    return _joined(stage(pairs.distinct(), "pairs"), bitmaps, "n", "bits").mapInPandas(_bounded, "a long, b long")


def _joined(pairs: DataFrame, described: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        own = described.select(F.col("c").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in columns])
        pairs = pairs.join(own, side)
    return pairs


def _links(texts: DataFrame, classes: DataFrame, near: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of set hashes whose sets are similar; their texts are fetched."""
    near = stage(near, "near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(classes, "c")
    wanted = small(wanted.select(F.col("first.doc_id").alias("id"), F.col("first.tag").alias("its_tag")).distinct())
    same = texts["doc_id"].eqNullSafe(F.col("id")) & (texts["tag"] == F.col("its_tag"))
    described = stage(
        texts.join(wanted, same, "left_semi").select("text")
        .mapInPandas(_described, "c long, shingles binary").dropDuplicates(["c"]),
        "sets",
    )
    return stage(_joined(near, described, "shingles").mapInPandas(_verified, "a long, b long"), "links")


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, tag, n_shingles and component_id of each row of docs.

    A document's set are the distinct shingles of WORDS words, A-Z lower-cased, or all its words
    if they are fewer; two documents link if their sets have a Jaccard similarity of 75 % or
    more; component_id is the smallest doc_id that links lead to, its own included.  A text that
    is null, empty or only white space has the empty set and is linked with nothing.  Equal texts
    and repeated rows link.  Rows with one doc_id and different texts are told apart, but count
    as one document where their doc_id is the smallest of its class.  A null doc_id never is a
    component_id; without another the component is null.  tag is a hash of the text.  An empty
    table gives no rows; other columns of docs are left out.

    Sets are of 64-bit hashes, and documents with equal sets are one class from here on.  A tile
    holds the classes that share one of their rarest shingles.  A class alone in its tiles is done;
    in small tiles all pairs of near sizes are candidates; in larger ones, in bands of sizes, each
    with the smallest of its band and with the next, which links a group of near copies without
    its pairs.  Candidates are checked by bitmaps, then exactly.  Similar sets meet in a small
    tile unless one of them has more shingles of larger tiles than its reserve, mostly near
    copies of many others; the pairs of those with members of their larger tiles are checked in a
    second round where they lie in different components after the first.
    """
    texts = _identified(docs)
    summaries = stage(
        texts.mapInPandas(_summaries, "doc_id long, tag long, n long, c long, bits binary, counts binary"), "summaries"
    )
    levels = docs.sparkSession.sparkContext.broadcast(_levels(summaries))
    rows = summaries.where("n >= 0").select("doc_id", "tag", "n", "c")
    node = F.coalesce("doc_id", F.lit(NAMELESS) + F.col("c").bitwiseAND(NAMELESS // 2 - 1))
    classes = stage(
        rows.where("n > 0").groupBy("c").agg(
            F.min(node).alias("node"), F.min(F.struct("doc_id", "tag")).alias("first"), F.first("n").alias("n")
        ),
        "classes",
    )
    tiled = stage(
        texts.select("text").mapInPandas(_prefix_rows(levels), "key long, c long, n int")
        .repartition("key").sortWithinPartitions("key", "n", "c")
        .mapInPandas(_candidates, "key long, a long, b long, n int, spare boolean"),
        "candidates",
    )
    first = classes.select("c", "first")
    bitmaps = summaries.where("n > 0").select("c", "n", "bits").dropDuplicates(["c"])
    links = _links(texts, first, _bounded_pairs(tiled.where("key IS NULL").select("a", "b"), bitmaps))
    roots = components(links)
    members = stage(tiled.where("key IS NOT NULL").select("key", F.col("a").alias("c"), "n", "spare"), "members")
    # Similar sets share a shingle that deals both to a tile without their reserve, so those rows
    # tell which sets are heavy, and the others meet again.
    needed = F.col("n") - F.ceil(F.col("n") * SIMILAR / OF) + 1
    heavy = members.groupBy("c", "n").agg(F.count("*").alias("tiles")).where(F.col("tiles") > F.floor(needed / 4))
    if not heavy.isEmpty():
        rooted = stage(
            members.where("NOT spare").join(roots.withColumnRenamed("node", "c"), "c", "left")
            .withColumn("root", F.coalesce("root", "c")).join(heavy.select("c", F.lit(True).alias("heavy")), "c", "left").na.fill(False, ["heavy"]),
            "rooted",
        )
        several = rooted.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("heavy").alias("any"), F.count("*").alias("g")
        ).where("low <> high AND any").select("key", "g")
        meeting = rooted.join(several, "key")
        firsts = meeting.groupBy("c").agg(F.slice(F.array_sort(F.collect_list("key")), 1, FIRST_KEYS).alias("firsts"))
        more = _links(
            texts, first,
            _blocks(meeting).join(firsts.join(bitmaps.select("c", "bits"), "c"), "c")
            .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .mapInPandas(_crossing, "a long, b long").distinct(),
        )
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    rooted = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    lowest = rooted.groupBy("root").agg(F.min("node").alias("component"))
    of_class = rooted.join(lowest, "root").select("c", "component")
    return rows.join(of_class, "c", "left").select(
        "doc_id", "tag", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id"))
        .when(F.col("component") < NAMELESS, F.col("component")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs without those that link to another that stays, with all their columns.

    Of each component the row of the smallest doc_id stays, of several the one of the smallest
    hash of its text, of equal ones any.  Rows that are linked with nothing stay.
    """
    linked = stage(link_documents(docs), "linked").where("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    linked = linked.withColumn("place", place).withColumn("group", F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("tag"))))
    first = linked.groupBy("group").agg(F.min("place").alias("first"))
    dropped = linked.join(first, "group").where("place <> first").select(
        F.col("doc_id").alias("id"), F.col("tag").alias("its_tag")
    )
    same = docs["doc_id"].eqNullSafe(F.col("id")) & (F.xxhash64(docs["text"]) == F.col("its_tag"))
    kept = docs.join(dropped.distinct(), same, "left_anti")
    repeated = linked.groupBy("doc_id", "tag").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    # Rows equal in doc_id and text, of which the hash says nothing: one of them stays.
    empty = F.coalesce(F.trim(F.translate("text", "\t\n\x0b\f\r", "     ")), F.lit("")) == ""
    return kept.where(empty).unionByName(kept.where(~empty).dropDuplicates(["doc_id", "text"]))
