"""Conversation structure repair by Wagner-Fischer alignment with the alternating grammar (s?(ua)+)?.

Turns are aligned with targets that alternate u and a, an s before them where a system turn is kept. One table gives the
costs for every feasible length at once, as the targets of one last letter are suffixes of each other; it is banded by
Ukkonen's bound from the cost of a greedy repair. Backtraces of all lengths of least cost run side by side and their
audits are compared letter by letter. Long conversations are cut into segments: each hands on, for every state that the
grammar can be in, the least cost, its audit and the hash of what is repaired so far, so that memory stays bounded.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import short_batches

SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Costs of a changed role, a deletion, an insertion and a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns of a segment.
SEGMENT = 1024
#: States of the grammar: nothing yet, an s, a u whose a is due, complete pairs.
START, SYSTEM, OPEN, CLOSED = range(4)
DUE = {START: "u", SYSTEM: "u", OPEN: "a", CLOSED: "u"}
ROLE = {"u": "user", "a": "assistant"}
NEVER = 1 << 40


@dataclass
class Turn:
    role: str
    text: str
    required: bool  #: a blank or repeated turn, which has to go
    extra: int  #: what it costs to keep it


class Alignment:
    """Least costs of aligning the turns from i on with the last q letters of a target that ends with `last`.

    A row holds q around the number of turns that may stay: farther off, insertions or deletions alone cost more than the
    greedy repair.
    """

    def __init__(self, turns: list[Turn], last: str, bound: int):
        self.turns, self.last, n = turns, last, len(turns)
        self.left = np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            self.left[i] = self.left[i + 1] + (not turns[i].required)
        self.below, above = bound // DELETE + 1, bound // INSERT + 1
        width = self.below + above + 1
        self.table = np.full((n + 1, width), NEVER, np.int64)
        x = np.arange(width)
        q = x - self.below
        self.table[n] = np.where(q >= 0, INSERT * q, NEVER)
        for i in range(n - 1, -1, -1):
            turn, after = turns[i], self.table[i + 1]
            if turn.required:
                self.table[i] = after + DELETE
                continue
            q = self.left[i] - self.below + x
            row = np.full(width, NEVER)
            row[:-1] = after[1:] + DELETE
            same = (q % 2 == 1) == (turn.role[:1] == last) if turn.role[:1] in ("u", "a") else np.zeros(width, bool)
            row = np.minimum(row, after + np.where(same, 0, REROLE) + turn.extra)  # after's q - 1 is in the same place
            row[q < 0] = NEVER
            self.table[i] = np.minimum.accumulate(row - INSERT * x) + INSERT * x

    def letter(self, q: int) -> str:
        return self.last if q % 2 else "ua"[self.last == "u"]

    def cost(self, i: int, q: int) -> int:
        at = q - int(self.left[i]) + self.below
        return int(self.table[i, at]) if q >= 0 and 0 <= at < self.table.shape[1] else NEVER

    def lengths(self, i: int, due: str, least: int) -> range:
        """Feasible numbers of letters whose first one is due."""
        low = max(least, int(self.left[i]) - self.below)
        low += self.letter(low) != due and low > 0
        return range(low, int(self.left[i]) - self.below + self.table.shape[1], 2)

    def audit(self, i: int, lengths: list[int]) -> str:
        """The ASCII-least edits from turn i on among those of least cost for any of the lengths, which cost the same."""
        out, n, open_ = [], len(self.turns), lengths
        while i < n or open_[0]:
            now = self.cost(i, open_[0])
            turn = self.turns[i] if i < n else None
            if turn and (gone := [q for q in open_ if self.cost(i + 1, q) + DELETE == now]):
                out.append("D")
                i, open_ = i + 1, gone
            elif more := [q - 1 for q in open_ if q and self.cost(i, q - 1) + INSERT == now]:
                out.append("I")
                open_ = more
            else:
                kept = [q for q in open_ if q and turn.role[:1] == self.letter(q) and self.cost(i + 1, q - 1) + turn.extra == now]
                out.append("K" if kept else "R")
                i, open_ = i + 1, [q - 1 for q in kept or [q for q in open_ if q and self.cost(i + 1, q - 1) + REROLE + turn.extra == now]]
        return "".join(out)


def greedy(turns: list[Turn]) -> int:
    """The cost of keeping each turn that can stay, with an insertion before it where its role is not due."""
    cost, due = 0, "u"
    for t in turns:
        if t.required:
            continue
        letter = t.role[:1] if t.role[:1] in ("u", "a") else None
        if letter is None:
            cost += DELETE
            continue
        cost += t.extra + (letter != due) * INSERT
        due = "a" if letter == "u" else "u"
    return cost


def segment_audits(turns: list[Turn], states: set[int], ends: set[int]) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> least cost and ASCII-least audit, for the given states."""
    n, required = len(turns), sum(t.required for t in turns)
    bound = greedy(turns) + 2 * INSERT  # of which one each makes up for the state before and after
    tables = {s: Alignment(turns, s, bound) for s in "ua"}
    found: dict[tuple[int, int], tuple[int, str]] = {}

    def better(key, cost, audit):
        if cost < NEVER and key[1] in ends and (key not in found or (cost, audit) < found[key]):
            found[key] = (cost, audit)

    def through(key, table, i, lengths, cost, before):
        costs = {q: table.cost(i, q) for q in lengths}
        least = min(costs.values(), default=NEVER)
        if least < NEVER and key[1] in ends and (key not in found or cost + least <= found[key][0]):
            better(key, cost + least, before + table.audit(i, [q for q, c in costs.items() if c == least]))

    for p in states:
        better((p, p), DELETE * n, "D" * n)
        for last, q in (("a", CLOSED), ("u", OPEN)):
            table = tables[last]
            through((p, q), table, 0, table.lengths(0, DUE[p], 1), 0, "")
            if p == START:
                for i, t in enumerate(turns):
                    if not t.required and t.role[:1] == "s":
                        through((p, q), table, i + 1, table.lengths(i + 1, "u", 1), DELETE * i + t.extra, "D" * i + "K")
        if p == START:
            for i, t in enumerate(turns):
                if not t.required and t.role[:1] == "s":
                    better((p, SYSTEM), DELETE * (n - 1) + t.extra, "D" * i + "K" + "D" * (n - 1 - i))
    return found


@dataclass
class State:
    cost: int = 0
    audit: str = ""
    sha: object = field(default_factory=hashlib.sha256)
    lines: int = 0

    def then(self, cost: int, audit: str, turns: list[Turn], state: int) -> State:
        out = State(self.cost + cost, self.audit + audit, self.sha.copy(), self.lines)
        left = iter(turns)
        due = DUE[state]
        for edit in audit:
            turn = None if edit == "I" else next(left)
            if edit == "D":
                continue
            kept_s = edit == "K" and state == START and out.lines == 0 and turn.role[:1] == "s"
            line = f"{turn.role}:{turn.text}" if edit == "K" else f"{ROLE[due]}:{turn.text if turn else ''}"
            out.sha.update((("\n" if out.lines else "") + line).encode())
            out.lines += 1
            due = "u" if kept_s or due == "a" else "a"
        return out


class Conversation:
    """One conversation's turns, in order; those of a segment are held at most."""

    def __init__(self, segment: int = SEGMENT):
        self.segment, self.turns, self.states = segment, [], {START: State()}
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.before = None

    def add(self, turn, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if len(self.turns) == self.segment:
            self._fold({START, SYSTEM, OPEN, CLOSED})
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if turn is not None and turn != self.last:
            self.first, self.last, self.distinct = turn if self.first is None else self.first, turn, self.distinct + 1
        self.turns.append(Turn(role, text, blank or duplicate, TRUNCATED * truncated))

    def _fold(self, ends: set[int]) -> None:
        found = segment_audits(self.turns, set(self.states), ends)
        best: dict[int, tuple[int, str, int, str]] = {}
        for (p, q), (cost, audit) in found.items():
            s = self.states[p]
            if q not in best or (s.cost + cost, s.audit + audit) < (best[q][0], best[q][1]):
                best[q] = (s.cost + cost, s.audit + audit, p, audit)
        self.states = {q: self.states[p].then(cost - self.states[p].cost, audit, self.turns, p) for q, (cost, _, p, audit) in best.items()}
        self.turns = []

    def row(self) -> tuple:
        self._fold({START, CLOSED})
        best = min((self.states[q] for q in (START, CLOSED) if q in self.states), key=lambda s: (s.cost, s.audit))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost, best.audit, best.sha.hexdigest()


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _repairs(segment: int):
    def run(batches):
        now, held, out = None, None, []

        def flush():
            found = list(zip(*out, strict=True))
            return pa.record_batch([pa.array(found[0], kind), *(pa.array(c, pa.int64()) for c in found[1:7]), *(pa.array(c, pa.string()) for c in found[7:])], ["conv_id", *COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, turn, role, text, gone, blank, duplicate, truncated in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "blank", "duplicate", "truncated")), strict=True):
                if held is None or conv != now:
                    if held is not None:
                        out.append((now, *held.row()))
                    now, held = conv, Conversation(segment)
                if not gone:
                    held.add(turn, role, text, blank, duplicate, truncated)
            if out:
                yield flush()
                out = []
        if held is not None:
            out.append((now, *held.row()))
            yield flush()

    return run


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone of conversations with faults put in by crc32 of conv_id:turn.

    Nulls are one space, in the hashed text too; turn itself stays null. Rows that are dropped stay as gone, without text,
    so that a conversation that loses all of them is still there.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("fault"))
    fault = F.col("fault")
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault <= 1, "").when(fault == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        (fault == 0).alias("gone"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def repaired(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    turns: conv_id, turn, role, text, and gone (true: a row that only tells that its conversation exists). Turns are in
    order of turn, null first; rows of one turn by role and text. A null conv_id is a conversation of its own; null roles
    and texts are to be replaced before. An empty table has no conversations. Texts are whole; a task holds a segment's.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = turns.select("conv_id", "turn", "role", "text", "gone", (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(*ENDS).alias("ended"), F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit(1), "text", "role").alias("g"))
    rows = rows.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "gone", "h", "g").orderBy("turn")
    rows = rows.withColumn("duplicate", ~F.col("blank") & (F.row_number().over(seen) > 1))
    rows = rows.withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & ~F.col("ended")).sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return rows.drop("h", "g", "ended").mapInArrow(_repairs(segment), f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def repaired_after_damage(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    with short_batches(conversations.sparkSession):
        return repaired(damaged(conversations), segment)
