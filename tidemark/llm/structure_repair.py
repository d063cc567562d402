"""Conversations brought into the order system, user, assistant, user, assistant by the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Costs of the edits; a row that is kept or reroled although truncated costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The order of the faults in which the first one of a row counts.
FAULTS = ("blank", "duplicate", "truncated")

# The grammar S -> nothing | T | s T, T -> u a | T u a as an LR(0) automaton: where a symbol
# leads from a state, how many states a completed rule takes off the stack, where T then leads,
# and the states in which the conversation may end.
SHIFT = {(0, "s"): 1, (0, "u"): 3, (1, "u"): 3, (3, "a"): 4, (2, "u"): 6, (5, "u"): 6, (6, "a"): 7}
REDUCE = {4: 2, 7: 3}
GOTO = {0: 2, 1: 5}
ACCEPTING = (0, 2, 5)
#: What any stack top needs at most, beyond its own cost, to follow another one's edits: an
#: inserted row to reach the same place between user and assistant, and a deleted system row
#: where only the other could still begin with it.  A top dearer by more never wins.
SLACK = INSERT + DELETE
#: Rows held back before it is looked up which of them are decided.
UNDECIDED = 256
#: Edits of one batch that a task returns, and characters of text after which it is cut.
BATCH, BATCH_TEXT = 10_000, 1 << 24


class Top(NamedTuple):
    """A stack with the cost of its edits; the tops of a frontier are in the order of their audits."""

    stack: tuple[int, ...]
    cost: int


def push(stack: tuple[int, ...], symbol: str) -> tuple[int, ...] | None:
    """The stack after a symbol, completed rules taken off; None if the grammar has no such step."""
    state = SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack += (state,)
    if state in REDUCE:
        stack = stack[: -REDUCE[state]]
        stack += (GOTO[stack[-1]],)
    return stack


def _inserted(top: Top) -> Iterator[tuple[tuple[int, ...], int, str]]:
    """The stacks that inserted rows make of a top, with cost and audit, until a state comes again."""
    stack, cost, audit, met = top.stack, top.cost, "", set()
    while stack[-1] not in met:
        yield stack, cost, audit
        met.add(stack[-1])
        stack = next(s for s in (push(stack, "u"), push(stack, "a")) if s)
        cost, audit = cost + INSERT, audit + "I"


@lru_cache(maxsize=100_000)
def step(frontier: tuple[Top, ...], initial: str, fault: str | None):
    """The frontier after a row, and where each of its tops comes from: (former top, audit).

    Every top inserts rows, then deletes, keeps or reroles the row.  Stacks with an equal top
    state allow the same rest of the conversation, so of these only the cheapest stays, and of
    equally cheap ones that with the least audit.  All audits of a frontier end with an edit of
    the last row, so none begins another, and what precedes decides their order first.  Costs
    are less what the cheapest top costs, so that few frontiers exist, each worked out once.
    """
    best: dict[int, tuple[int, int, str, tuple[int, ...]]] = {}
    for i, top in enumerate(frontier):
        for stack, cost, audit in _inserted(top):
            found = [(stack, cost + DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                more = TRUNCATED if fault == "truncated" else 0
                found += [(push(stack, initial), cost + more, "K")]
                found += [(push(stack, role), cost + REROLE + more, "R") for role in "ua"]
            for after, total, letter in found:
                if after is not None:
                    candidate = (total, i, audit + letter, after)
                    state = after[-1]
                    best[state] = min(best.get(state, candidate), candidate)
    least = min(total for total, *_ in best.values())
    tops = sorted((i, audit, total - least, stack) for total, i, audit, stack in best.values() if total - least <= SLACK)
    return tuple(Top(stack, cost) for _, _, cost, stack in tops), tuple((i, audit) for i, audit, _, _ in tops)


@lru_cache(maxsize=100_000)
def end(frontier: tuple[Top, ...]) -> tuple[int, str]:
    """The top from which the conversation ends best, and the rows inserted there."""
    return min(
        (cost, i, audit) for i, top in enumerate(frontier)
        for stack, cost, audit in _inserted(top) if stack[-1] in ACCEPTING
    )[1:]


class Repair:
    """The edits of one conversation, handed out as soon as no later row can change them."""

    def __init__(self) -> None:
        self.frontier: tuple[Top, ...] = (Top((0,), 0),)
        self.pending: list[tuple[tuple, tuple]] = []
        self.look_at = UNDECIDED
        self.after = ""

    def add(self, row: tuple, role: str, fault: str | None) -> Iterator[tuple]:
        """Takes the next row; yields (edit, role, row) that are decided by now."""
        self.frontier, moves = step(self.frontier, role[:1] if role[:1] in ("s", "u", "a") else "", fault)
        self.pending.append((moves, row))
        if len(self.pending) >= self.look_at:
            tops = set(range(len(self.frontier)))
            for n in range(len(self.pending), 0, -1):
                if len(tops) == 1:
                    yield from self._edits(n, tops.pop(), "")
                    break
                tops = {self.pending[n - 1][0][top][0] for top in tops}
            self.look_at = max(UNDECIDED, 2 * len(self.pending))

    def close(self) -> Iterator[tuple]:
        """The edits that were still undecided."""
        top, audit = end(self.frontier)
        yield from self._edits(len(self.pending), top, audit)

    def _edits(self, n: int, top: int, last: str) -> Iterator[tuple]:
        """The edits of the first n pending rows if they lead to a top, and rows inserted after them."""
        path = []
        for moves, row in reversed(self.pending[:n]):
            top, audit = moves[top]
            path.append((audit, row))
        del self.pending[:n]
        for audit, row in [*reversed(path), (last, None)]:
            for edit in audit:
                role = ""
                if edit in "IR":
                    role = "assistant" if self.after == "u" else "user"
                elif edit == "K":
                    role = row[1]
                if edit != "D":
                    self.after = role[:1]
                yield edit, role, None if edit == "I" else row


def damage(conversations: DataFrame) -> DataFrame:
    """conversations with faults made by crc32(`conv_id:turn`) modulo 20, nulls as one space.

    0 drops the row (present is false), 1 empties its text, 2 removes its ends of sentences, 3
    repeats it, 4 makes it the user's.
    """
    def filled(name: str) -> Column:
        return F.coalesce(conversations[name].cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
        (kind != 0).alias("present"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each edit, in order: conv_id, step, edit, turn, was, role, text, fault, cost.

    The rows of a conversation are taken by turn, nulls first, then by role and text.  The first
    of its faults counts for a row: blank (no character but white space), duplicate (role and
    text of an earlier row), truncated (the last character but white space is none of `.!?`).
    Edits are K (keep, free), R (give it the role user or assistant), D (delete; blank and
    duplicate rows must be), I (insert an empty row of user or assistant); the roles left begin
    with s at most once and then alternate u and a, which ends it.  The cheapest edits are taken
    and of these the ones whose letters are least.  was is the role before and null for an
    inserted row, role and text are what stays and null for a deleted one.

    A null role or text is one space; an initial other than s, u or a, or none at all, fits
    nowhere.  Rows without a conv_id are one conversation; repeated rows are duplicates.  Where a
    boolean column present is false the row is no part of the conversation; one left without
    rows has one row without an edit.  An empty table gives no rows; other columns are left out.

    A generalised LR parser reads the rows as they stream by, sorted within their partition, with
    a graph-structured stack whose equal tops are merged; it holds back only rows that later ones
    may still decide.  One conversation is read by one task, however long, but never held whole.
    """
    present = F.col("present") if "present" in conversations.columns else F.lit(True)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.coalesce(present, F.lit(False)).alias("present"),
    ).repartition("conv_id")
    # The partition is one of conv_id already, so the window only sorts it.
    before = F.row_number().over(
        Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    )
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), FAULTS[0])
        .when(F.col("before") > 1, FAULTS[1])
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), FAULTS[2])
    )
    rows = (
        rows.withColumn("before", before).withColumn("fault", fault)
        .sortWithinPartitions(
            F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "before"
        )
        .select("conv_id", "turn", "role", "text", "fault", "present")
    )
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(
        _edit,
        f"conv_id {kind}, step long, edit string, turn long, was string, role string, text string, fault string, cost int",
    )


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "step", "edit", "turn", "was", "role", "text", "fault", "cost")
    types: list = [None, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int32()]
    out: list[tuple] = []
    current: tuple | None = None
    steps, size = 0, 0

    def record(edits: Iterator[tuple]) -> None:
        nonlocal steps, size
        for edit, role, row in edits:
            turn, was, text, fault = row or (None, None, "", None)
            cost = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
            if edit == "D":
                role = text = None
            elif fault == "truncated":
                cost += TRUNCATED
            out.append((current[0], steps, edit, turn, was, role, text, fault, cost))
            steps += 1
            size += len(text or "")

    def finish() -> None:
        if current is not None:
            record(repaired.close())
            if not steps:
                out.append((current[0], 0, *[None] * 6, 0))

    def flush() -> pa.RecordBatch:
        nonlocal size
        columns = [pa.array(column, kind) for column, kind in zip(zip(*out), types)]
        out.clear()
        size = 0
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        types[0] = batch.schema.field("conv_id").type
        for conv_id, turn, role, text, fault, present in zip(*[c.to_pylist() for c in batch.columns]):
            if current != (conv_id,):
                finish()
                current, repaired, steps = (conv_id,), Repair(), 0
            if present:
                record(repaired.add((turn, role, text, fault), role, fault))
            if len(out) >= BATCH or size >= BATCH_TEXT:
                yield flush()
    finish()
    if out:
        yield flush()


def summarise(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of `repair`, read in the order in which it comes.

    conv_id, gaps (turns missing between the first and the last), blank, duplicate, truncated,
    illegal (neighbours among the rows before whose initials are not su, ua or au), cost, audit
    (the letters of the edits), repaired_sha256 (of the repaired `role:text`, one a line).
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.mapInArrow(
        _summary,
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
        " audit string, repaired_sha256 string",
    )


class _Summary:
    def __init__(self, conv_id) -> None:
        self.conv_id, self.turns, self.first, self.last = conv_id, 0, None, None
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = 0
        self.before: str | None = None
        self.audit: list[str] = []
        self.digest, self.between = hashlib.sha256(), b""

    def add(self, edit, turn, was, role, text, fault, cost) -> None:
        self.audit.append(edit)
        self.cost += cost
        if was is not None:
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
            self.illegal += self.before is not None and self.before + was[:1] not in ("su", "ua", "au")
            self.before = was[:1]
            if fault is not None:
                self.faults[fault] += 1
        if role is not None:
            self.digest.update(self.between + f"{role}:{text}".encode())
            self.between = b"\n"

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()
        )


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256")
    current = None
    for batch in batches:
        out = []
        for conv_id, _, edit, *rest in zip(*[c.to_pylist() for c in batch.columns]):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    out.append(current.row())
                current = _Summary(conv_id)
            if edit is not None:
                current.add(edit, *rest)
        kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(current.row(), kinds)], names)
