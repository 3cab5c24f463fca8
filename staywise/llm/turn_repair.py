"""Repair of a conversation's structure by a secondary-sorted stream that carries the state of a dynamic programme.

The roles of a conversation must read ``(s?(ua)+)?``: an optional system turn, then user and assistant in turn. The
cheapest edits are found by dynamic programming over the rows and the four states of that pattern.

1. Rows are dealt by conversation and sorted by turn once; places, duplicates and the other faults are columns.
2. A first stream reads each conversation from its last row to its first. It carries the cost of the rest from each
   state, four numbers, across Arrow batches, and spills one byte a row: for each state the edit to choose there (two bits).
   The rows with their back pointers are written to the shared folder, so a conversation of any length is no longer in
   memory than its Arrow batch, and a lost executor costs a part of this stream.
3. A second stream reads them from the first row on, follows the pointers, and puts together the audit, the counts and
   the hash of the repaired text, which is fed row by row.

A conversation stays in one task in both streams, since its hash is a sequential one; what a task holds of it are four costs,
a hash state and the audit, which is a result. The edit chosen in a state also fixes the state after it, so the least
letter among the cheapest edits at each step gives the least audit of all.

Inputs without a result of their own: an empty table gives no rows; nulls in role and text, and in what the damage is
drawn by, count as one space; a null conv_id is a conversation; a null turn comes first; rows of equal turn are in
order of role, then text; repeated rows are rows; a role whose first character is not s, u or a can't be kept, an empty one neither;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise.session import materialize

#: Production parameters: costs of the edits, and the shares of the damage.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
PARTS = 20

# States: before any row, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or changed row leads from each state, and its role.
FORCED = (USER, USER, ASSISTANT, USER)
FORCED_ROLE = ("user", "user", "assistant", "user")
#: Where a kept row leads, by state and the first character of its role.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
LETTERS = "DIKR"  # in ASCII order
FINE, BLANK, DUPLICATE, CUT = range(4)
GOOD_PAIRS = {"su", "ua", "au"}


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) after the damage; rows that it drops stay as marks of their conversation."""
    space = F.lit(" ")
    drawn = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    part = F.crc32(drawn.cast("binary")) % PARTS
    text = F.when(part == 1, "").when(part == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(part == 4, "user").otherwise(F.col("role"))
    given = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])
    out = given.select("conv_id", "turn", role.alias("role"), text.alias("text"), (part == 0).alias("gone"), part.alias("part"))
    return out.withColumn("copy", F.explode(F.when(F.col("part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("part", "copy")


def _text_tail() -> Column:
    """The last character of the text that is not white space, or an empty string."""
    return F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)


def faulty_rows(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by conversation, with their place in it (from 0 on) and first fault; rows that are gone come last.

    Both windows and what follows use the one partitioning by conversation.
    """
    tail = rows.repartition("conv_id").withColumn("tail", _text_tail())
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("gone"), *order)) - 1
    again = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy("place"))
    fault = (
        F.when(F.col("tail") == "", BLANK).when(again > 1, DUPLICATE).when(~F.col("tail").isin(".", "!", "?"), CUT).otherwise(FINE)
    )
    return tail.withColumn("place", place).select("conv_id", "turn", "role", "text", "gone", "place", fault.alias("fault"))


@lru_cache(maxsize=1 << 16)
def _back(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Costs of the rest before a row, given those behind it, and the pointers: two bits for each state."""
    extra = TRUNCATED if fault == CUT else 0
    edits = []
    for q in range(4):
        best = (DELETE + after[q], "D")
        if fault not in (BLANK, DUPLICATE):
            if (q, initial) in KEPT:
                best = min(best, (extra + after[KEPT[q, initial]], "K"))
            best = min(best, (REROLE + extra + after[FORCED[q]], "R"))
        edits.append(best)
    for _ in range(4):  # insertions before the row: the longest chain without a loop has four states
        edits = [min(edits[q], (INSERT + edits[FORCED[q]][0], "I")) for q in range(4)]
    pointers = sum(LETTERS.index(letter) << (2 * q) for q, (_, letter) in enumerate(edits))
    return tuple(cost for cost, _ in edits), pointers


def _end_costs() -> tuple[int, ...]:
    costs = [0 if q in ENDS else 1 << 30 for q in range(4)]
    for _ in range(4):
        costs = [min(costs[q], INSERT + costs[FORCED[q]]) for q in range(4)]
    return tuple(costs)


END_COSTS = _end_costs()


def _point_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the pointers to rows that come last place first; the costs are kept relative to their least."""
    conversation, costs = object(), END_COSTS
    for batch in batches:
        pointers = []
        for conv, role, fault, gone in zip(batch["conv_id"], batch["role"], batch["fault"], batch["gone"]):
            if conv != conversation:
                conversation, costs = conv, END_COSTS
            if gone:
                pointers.append(0)
                continue
            least = min(costs)
            costs, found = _back(tuple(c - least for c in costs), role[:1], fault)
            pointers.append(found)
        yield batch.assign(pointers=pd.Series(pointers, dtype="int16", index=batch.index))


class _Repair:
    """What the second stream carries of a conversation."""

    def __init__(self, conv_id: str | None) -> None:
        self.conv_id = conv_id
        self.state = START
        self.cost = self.illegal = self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.first_turn = self.last_turn = None
        self.before = None  # the first character of the last row's role
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.written = False

    def _put(self, row: str) -> None:
        self.hash.update((("\n" if self.written else "") + row).encode())
        self.written = True

    def _insert(self) -> None:
        self.audit.append("I")
        self.cost += INSERT
        self._put(f"{FORCED_ROLE[self.state]}:")
        self.state = FORCED[self.state]

    def add(self, turn: str | None, role: str, text: str, fault: int, pointers: int) -> None:
        if turn is not None:
            turn = int(turn)
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        self.faults[fault] += 1
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in GOOD_PAIRS
        self.before = initial
        while (letter := LETTERS[pointers >> (2 * self.state) & 3]) == "I":
            self._insert()
        self.audit.append(letter)
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if fault == CUT else 0
        if letter == "R":
            self.cost += REROLE
            role, self.state = FORCED_ROLE[self.state], FORCED[self.state]
        else:
            self.state = KEPT[self.state, initial]
        self._put(f"{role}:{text}")

    def result(self) -> tuple:
        while self.state not in ENDS:
            self._insert()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        _, blank, duplicate, cut = self.faults
        return self.conv_id, gaps, blank, duplicate, cut, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from rows that come first place first."""
    current: _Repair | None = None
    for batch in batches:
        done = []
        columns = [batch[c] for c in ("conv_id", "turn", "role", "text", "fault", "pointers", "gone")]
        for conv, turn, role, text, fault, pointers, gone in zip(*columns):
            if current is None or conv != current.conv_id:
                if current is not None:
                    done.append(current.result())
                current = _Repair(conv)
            if not gone:
                current.add(turn, role, text, fault, pointers)
        yield pd.DataFrame(done, columns=COLUMNS)
    if current is not None:
        yield pd.DataFrame([current.result()], columns=COLUMNS)


def repaired(rows: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text, gone): COLUMNS."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    # numbers as text: a column with nulls would come to pandas as floating point
    faulty = faulty_rows(rows.withColumn("conv_id", F.col("conv_id").cast("string"))).withColumn("turn", F.col("turn").cast("string"))
    schema = "conv_id string, turn string, role string, text string, gone boolean, place int, fault int, pointers short"
    backwards = faulty.sortWithinPartitions("conv_id", F.col("place").desc())
    pointed = materialize(backwards.mapInPandas(_point_back, schema), "back-pointers")
    forwards = pointed.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return forwards.mapInPandas(_follow, RESULT).withColumn("conv_id", F.col("conv_id").cast(kind))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The conversations after the drawn damage, repaired."""
    return repaired(damaged(conversations.select("conv_id", "turn", "role", "text")))
