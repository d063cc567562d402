"""The repair of conversations against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

from tidemark.llm import structure_repair

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit, [role:text]) of rows (role, text, fault) by a best-first search over places and roles so far."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for role in ("user", "assistant"):
            if role[0] in follow:
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*out, f"{role}:")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
        if fault in ("blank", "duplicate"):
            continue
        more = fault == "truncated"
        if role[:1] and role[:1] in follow:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))
        for new in ("user", "assistant"):
            if new[0] in follow:
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, new[0], (*out, f"{new}:{text}")))


def plainly(original):
    """The rows of the query for (conv_id, turn, role, text) rows."""
    conversations = defaultdict(list)
    for conv_id, turn, role, text in original:
        role, text = (" " if x is None else x for x in (role, text))
        rows = conversations[conv_id]
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = []
    for conv_id, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faulty = set(), []
        for _, role, text in rows:
            kept = text.strip(BLANK)
            fault = (
                "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
            )
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
        cost, audit, out = cheapest(faulty)
        faults = [sum(f == name for *_, f in faulty) for name in structure_repair.FAULTS]
        found.append((
            conv_id, gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def query(df):
    return structure_repair.summarise(structure_repair.repair(structure_repair.damage(df)))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_agrees_with_search(spark):
    df = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    original = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(query(df)) == plainly(original)


def test_random_conversations(spark):
    rng = random.Random(7)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", " ", "unknown", None]
    texts = ["Yes.", "No", "", " \n", "Why?", "Well! ", "A. b", None, " ", "...", "Long. " * 50]
    rows = [
        (rng.choice([None, *range(400)]), rng.choice([None, 0, 1, 2, 3, 5, 8, 13, -4]), rng.choice(roles), rng.choice(texts))
        for _ in range(2500)
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS step", "2 AS before", "3 AS copy", "4 AS fault")
    assert rows_of(query(df)) == plainly(rows)


def test_long_conversation_is_handed_out_before_its_end(spark):
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"Text {i % 3000}{rng.choice(['.', ''])}") for i in range(6000)]
    assert rows_of(query(spark.createDataFrame(rows, SCHEMA))) == plainly(rows)
    own, handed = structure_repair.Repair(), 0
    for i in range(5000):
        handed += len(list(own.add((i, "user", "x.", None), ("user", "assistant")[i % 2], None)))
    assert handed > 4000 and len(own.pending) < 1000


def test_edits_and_empty_table(spark):
    rows = [(1, 0, "assistant", "Hello."), (2, 0, "user", "Hi."), (2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, SCHEMA)
    edits = [tuple(r) for r in structure_repair.repair(df).orderBy("conv_id", "step").collect()]
    assert [(r[0], r[2], r[5], r[7], r[8]) for r in edits] == [
        (1, "I", "user", None, 2), (1, "K", "assistant", None, 0),
        (2, "K", "user", None, 0), (2, "D", None, "duplicate", 3), (2, "K", "assistant", None, 0),
    ]
    assert query(df.where("false")).count() == 0
