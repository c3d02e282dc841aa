"""Repair of conversations whose turns are blank, repeated, cut short, missing or given to the wrong speaker.

A repaired conversation is empty, or an optional system turn and then user and assistant in alternation, ending with the
assistant. Every row is kept, given to the other speaker, or deleted; turns without text may be inserted. Which edits are
cheapest is decided by a dynamic program with four states: nothing yet, after system, after user, after assistant.

Rows are dealt out by conversation once and then streamed twice, sorted within their partition. The first stream runs from
the last turn to the first and carries, across Arrow batches, the cost of ending well from each state; what it leaves on
each row is one byte, the best edit in each state. The second runs forward, follows these bytes, and hashes the repaired
text as it goes. Spark sorts between the two, so the bytes of a giant conversation spill with its rows, and no task holds
more than a batch and one letter for each edit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# Fixed costs of the edits.
DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 3  # an initial that is none of "sua"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
LETTERS = "DIKR"  # in the order in which ties are decided
_FOLLOWS = (USER, USER, ASSISTANT, USER)  # the state behind an inserted or reroled turn
_KEEPS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
_SPOKEN = {USER: "user", ASSISTANT: "assistant"}
_LAST = (0, 2 * INSERT, INSERT, 0)  # the cost behind the last row, by state


@cache
def edits(later: tuple[int, int, int, int], initial: int, fault: int) -> tuple[tuple[int, int, int, int], int]:
    """Costs before a row, less the smallest of them, from those behind it; and the best edit of each state in one byte."""
    options: list[dict[str, int]] = []
    for state in range(4):
        own = {"D": DELETE + later[state]}
        if fault not in (BLANK, DUPLICATE):
            worse = CUT_SHORT if fault == TRUNCATED else 0
            own["R"] = REROLE + worse + later[_FOLLOWS[state]]
            if (kept := _KEEPS.get((state, initial))) is not None:
                own["K"] = worse + later[kept]
        options.append(own)
    costs = [min(own.values()) for own in options]
    alternate = {USER: min(costs[USER], INSERT + costs[ASSISTANT]), ASSISTANT: min(costs[ASSISTANT], INSERT + costs[USER])}
    best = [min(costs[s], INSERT + alternate[USER]) for s in (START, SYSTEM)] + [alternate[USER], alternate[ASSISTANT]]
    packed = 0
    for state, own in enumerate(options):
        own["I"] = INSERT + best[_FOLLOWS[state]]
        packed |= LETTERS.index(min(x for x, c in own.items() if c == best[state])) << 2 * state
    least = min(best)
    return tuple(c - least for c in best), packed


def _order(forward: bool) -> list[Column]:
    columns = [F.col(c) for c in ("turn", "role", "text", "again")]
    return [F.col("conv_id"), *[c.asc_nulls_first() if forward else c.desc_nulls_last() for c in columns]]


def _judged(rows: DataFrame) -> DataFrame:
    """Rows dealt out by conversation, each with its first fault and the initial of its role."""
    rows = rows.repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "alive", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("again", F.row_number().over(earlier) > 1)  # of equal rows all but one, at equal turns as well
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(stripped == "", BLANK).when(F.col("again"), DUPLICATE)
    fault = fault.when(~F.right(stripped, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(NONE)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    return rows.withColumn("fault", fault.cast("int")).withColumn("initial", code.cast("int"))


def _planned(rows: DataFrame) -> DataFrame:
    """Rows with the best edit of each state, streamed from each conversation's last turn to its first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, later = object(), _LAST
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "alive", "initial", "fault")]
            for conv_id, alive, initial, fault in zip(*columns):
                if conv_id != conversation:
                    conversation, later = conv_id, _LAST
                packed = 0
                if alive:
                    later, packed = edits(later, initial, fault)
                out.append(packed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "best"])

    ordered = _judged(rows).sortWithinPartitions(*_order(False))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    return ordered.mapInArrow(work, f"{schema}, best int").sortWithinPartitions(*_order(True))


class _Conversation:
    """One conversation as its rows go by in order: what is wrong with it, and the edits that mend it."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.state, self.cost = conv_id, START, 0
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.low, self.turn, self.turns = None, None, 0
        self.audit = bytearray()

    def seen(self, turn: int | None, role: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:  # turns come in order, nulls first
            self.low = turn if self.turn is None else self.low
            self.turn, self.turns = turn, self.turns + 1

    def edit(self, role: str, text: str, initial: int, fault: int, best: int) -> Iterator[tuple[str, str | None, str]]:
        """Edits up to and with that of this row: the letter, and the role and text that stand then (role None: deleted)."""
        while True:
            letter = LETTERS[best >> 2 * self.state & 3]
            self.audit += letter.encode()
            if letter == "I":
                yield self.insert()
                continue
            if letter == "D":
                self.cost += DELETE
                yield letter, None, ""
                return
            self.cost += CUT_SHORT if fault == TRUNCATED else 0
            if letter == "R":
                self.cost += REROLE
                self.state = _FOLLOWS[self.state]
                role = _SPOKEN[self.state]
            else:
                self.state = _KEEPS[self.state, initial]
            yield letter, role, text
            return

    def insert(self) -> tuple[str, str, str]:
        self.cost += INSERT
        self.state = _FOLLOWS[self.state]
        return "I", _SPOKEN[self.state], ""

    def end(self) -> Iterator[tuple[str, str, str]]:
        while _LAST[self.state]:
            self.audit += b"I"
            yield self.insert()

    def gaps(self) -> int:
        return 0 if self.turn is None else self.turn - self.low + 1 - self.turns


def _columns(rows: DataFrame) -> DataFrame:
    """The columns that are needed; nulls of role and text are one space. ``alive`` is false where a row only names an id."""
    alive = F.col("alive") if "alive" in rows.columns else F.lit(True)
    space = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *space, alive.alias("alive"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, int | None, str, str | None, str, bool]]:
    """Edits in order with the conversation they belong to and the turn of the row; the last entry of each is its end."""
    now = None
    for batch in batches:
        names = ("conv_id", "turn", "role", "text", "alive", "initial", "fault", "best")
        for conv_id, turn, role, text, alive, initial, fault, best in zip(*[batch.column(c).to_pylist() for c in names]):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield from _ended(now)
                now = _Conversation(conv_id)
            if alive:
                now.seen(turn, role, fault)
                for letter, to_role, to_text in now.edit(role, text, initial, fault, best):
                    yield now, None if letter == "I" else turn, letter, to_role, to_text, False
    if now is not None:
        yield from _ended(now)


def _ended(now: _Conversation) -> Iterator[tuple[_Conversation, int | None, str, str | None, str, bool]]:
    for letter, role, text in now.end():
        yield now, None, letter, role, text, False
    yield now, None, "", None, "", True


def report(rows: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, the cheapest repair, and the hash of the repaired text.

    Rows are taken by ``turn``, nulls first; rows of one turn by role and text. Null roles and texts are one space; rows
    with a null ``conv_id`` are one conversation. A row's first fault counts: blank, then duplicate (role and text were
    there before), then truncated (it does not end in ``.!?``). ``illegal`` counts neighbours whose roles do not follow; an
    empty role follows nothing.
    ``audit`` spells the edits in order: Delete, Insert, Keep, Rerole. Empty tables give no rows; other columns are left
    out. Rows whose optional column ``alive`` is false only make sure that their conversation is listed.
    """
    planned = _planned(_columns(rows))
    kind = planned.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, hashed, first = [], hashlib.sha256(), True
        for now, _, _, role, text, over in _walk(batches):
            if role is not None:
                hashed.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            if over:
                numbers = (now.gaps(), *now.faults[1:], now.illegal, now.cost)
                out.append((now.conv_id, *numbers, now.audit.decode(), hashed.hexdigest()))
                hashed, first = hashlib.sha256(), True
                if len(out) >= 1000:
                    yield made(out)
                    out = []
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        ids, *rest = zip(*out)
        types = [pa.int64()] * len(counts) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(c, t) for c, t in zip(rest, types)]], names)

    names = ["conv_id", *counts, "audit", "repaired_sha256"]
    numbers = ", ".join(f"{c} long" for c in counts)
    return planned.mapInArrow(work, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: place from 0, role, text, the edit, and the turn of the row they come from.

    Rows are treated as in ``report``. A conversation of which nothing is left has no rows.
    """
    planned = _planned(_columns(rows))
    kind = planned.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, size = [], 0, 0
        for now, turn, letter, role, text, over in _walk(batches):
            if over:
                place = 0
            elif role is not None:
                out.append((now.conv_id, place, turn, role, text, letter))
                place, size = place + 1, size + len(text)
            if len(out) >= 1000 or size > 1 << 20:
                yield made(out)
                out, size = [], 0
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        ids, *rest = zip(*out)
        types = [pa.int64()] * 2 + [pa.string()] * 3
        return pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(c, t) for c, t in zip(rest, types)]], names)

    names = ["conv_id", "place", "turn", "role", "text", "edit"]
    return planned.mapInArrow(work, f"conv_id {kind}, place long, turn long, role string, text string, edit string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by ``crc32("conv_id:turn") % 20``: 0 drops a row, 1 empties its text, 2 takes its ``.!?``
    away, 3 repeats it, 4 gives it to the user. A null is one space. Dropped rows stay as rows that are not ``alive``."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, "".join(ENDS), "")).otherwise(text)
    copies = F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("alive"),
    )
