"""Conversation structure repair: the cheapest edits that make a conversation alternate.

Rows are dealt by conversation and sorted by turn once. The repair reads them
as a stream and carries, across Arrow batches, the state of a dynamic programme
over the structure reached so far (nothing yet, after a system row, after a
user row, after an assistant row): for each state the least cost, the order of
the best edit strings, and the running digest of the conversation repaired that
way. What each state came from is kept as three bytes a row, and spilled to a
file of the task for giant conversations, from which the edits are read back at
the end. Nothing else grows with a conversation.

Of two edit strings for the same rows neither is the beginning of the other
(inserts stand before the edit of a row), so which one is ASCII-less is settled
at the first difference and the order of the states is all there is to carry.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPILL_BYTES = 8_000_000
_ALIVE = r"[^\x20\x09-\x0D]"
_WHITE = " \t\n\x0b\x0c\r"
_NONE = 1 << 60
#: States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.
_NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_AFTER = {"s": 1, "u": 2, "a": 3}
#: Edits of a row, in ASCII order; I inserts a row before it.
_EDITS = ("D", "IK", "IR", "K", "R")
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 2, 3, 2, 1


def damaged(chats: DataFrame) -> DataFrame:
    """The rows of ``conversations`` (conv_id, turn, role, text) after the benchmark's damage, plus ``dropped``.

    Null texts and roles become one blank. crc32 of ``conv_id:turn`` (nulls one
    blank) modulo 20 decides: 0 drops a row (it stays as a mark, with
    ``dropped`` true), 1 empties the text, 2 takes ``.!?`` out of it, 3 repeats
    the row, 4 sets the role to user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = chats.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies.alias("copy"))
    return rows.select("conv_id", "turn", "role", "text", "dropped", F.explode("copy").alias("copy")).drop("copy")


def fault(role_seen: Column) -> Column:
    """``blank``, ``duplicate``, ``truncated`` or NULL: the first fault of a row."""
    last = F.substring(F.rtrim("text", F.lit(_WHITE)), -1, 1)
    return (
        F.when(~F.col("text").rlike(_ALIVE), "blank")
        .when(role_seen, "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )


class _Choices:
    """Three bytes a row: for each state the state before and the edit; beyond a bound they go to a file."""

    def __init__(self) -> None:
        self.recent = bytearray()
        self.file: BinaryIO | None = None

    def add(self, came: list[tuple[int, int]]) -> None:
        word = 0
        for state, (before, edit) in enumerate(came):
            word |= (before << 3 | edit) << (5 * state)
        self.recent += word.to_bytes(3, "little")
        if len(self.recent) >= SPILL_BYTES:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.recent)
            self.recent.clear()

    def backwards(self) -> Iterator[int]:
        """The words from the last row to the first."""
        yield from _words(self.recent)
        if self.file is not None:
            at = self.file.tell()
            while at:
                size = min(at, 3 * (1 << 20))
                at -= size
                self.file.seek(at)
                yield from _words(self.file.read(size))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _words(data: bytes | bytearray) -> Iterator[int]:
    for at in range(len(data) - 3, -1, -3):
        yield data[at] | data[at + 1] << 8 | data[at + 2] << 16


class Repair:
    """One conversation: rows go in by turn, the result comes out at the end."""

    def __init__(self) -> None:
        self.costs = [0, _NONE, _NONE, _NONE]
        self.order = [0, 1, 2, 3]  # of the edit strings of the states: a smaller number is ASCII-less
        self.digests = [hashlib.sha256(), None, None, None]
        self.began = [False] * 4  # whether the state's repaired conversation has a row
        self.choices = _Choices()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.initial = self.least = self.last = None

    def _moves(self, fault: str | None, initial: str) -> Iterator[tuple[int, int, int, int]]:
        """Cost, state before, edit and state after of everything that can be done with a row."""
        extra = _TRUNCATED if fault == "truncated" else 0
        for state, cost in enumerate(self.costs):
            if cost >= _NONE:
                continue
            yield cost + _DELETE, state, 0, state
            if fault in ("blank", "duplicate"):
                continue
            inserted = _AFTER[_NEXT[state][0]]
            for edit, at, own in ((3, state, 0), (1, inserted, _INSERT)):
                wanted = _NEXT[at][0]
                yield cost + own + extra + _REROLE, state, edit + 1, _AFTER[wanted]
                if initial == wanted or initial == "s" and at == 0:
                    yield cost + own + extra + _KEEP, state, edit, _AFTER[initial]

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if fault is not None:
            self.counts[fault] += 1
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last = turn
            self.turns += 1
        best: list[tuple | None] = [None] * 4
        for cost, state, edit, after in self._moves(fault, initial):
            key = (cost, self.order[state], edit)
            if best[after] is None or key < best[after][0]:
                best[after] = (key, state, edit)
        ranks = sorted((b[0][1:], after) for after, b in enumerate(best) if b is not None)
        order = [0] * 4
        for rank, (_, after) in enumerate(ranks):
            order[after] = rank
        digests, began = [None] * 4, [False] * 4
        for after, b in enumerate(best):
            if b is not None:
                digests[after], began[after] = self._extended(b[1], _EDITS[b[2]], role, text)
        self.costs = [_NONE if b is None else b[0][0] for b in best]
        self.choices.add([(0, 0) if b is None else b[1:] for b in best])
        self.order, self.digests, self.began = order, digests, began

    def _extended(self, state: int, edits: str, role: str, text: str) -> tuple:
        """The digest of what the edits make of a state's conversation and a row."""
        digest, began, at = self.digests[state].copy(), self.began[state], state
        for edit in edits:
            if edit == "D":
                continue
            new = role if edit == "K" else _NEXT[at]
            line = f"{new}:" if edit == "I" else f"{new}:{text}"
            digest.update(("\n" + line if began else line).encode())
            began, at = True, _AFTER[new[0]]
        return digest, began

    def result(self) -> tuple[int, int, int, int, int, int, str, str]:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
        ends = {0: "", 1: "II", 2: "I", 3: ""}
        cost, _, state = min((c + _INSERT * len(ends[s]), self.order[s], s) for s, c in enumerate(self.costs) if c < _NONE)
        digest = self._extended(state, ends[state], "", "")[0].hexdigest()
        parts = [ends[state]]
        for word in self.choices.backwards():
            choice = word >> (5 * state) & 31
            parts.append(_EDITS[choice & 7])
            state = choice >> 3
        self.choices.close()
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return gaps, *self.counts.values(), self.illegal, cost, "".join(reversed(parts)), digest


def repaired(chats: DataFrame, mark_column: str | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    ``chats`` has conv_id, turn, role and text; rows where the boolean
    ``mark_column``, if named, is true only say that a conversation exists. Rows of a conversation are taken
    by turn, nulls first, ties by role and text. Null roles and texts count as
    one blank. Faults: ``blank`` (nothing but white space), ``duplicate`` (role
    and text of an earlier row), ``truncated`` (the last visible character is
    none of ``.!?``). Edits, by the initial of a role: K keeps a row (0), R gives
    it the role user or assistant (2), D deletes it (3; blank and duplicate rows
    must go), I inserts an empty row (2); a truncated row that stays adds 1. The
    cheapest edits whose roles match ``(s?(ua)+)?`` are told in ``audit``, ties
    ASCII-least. ``gaps`` is the number of missing turns; ``illegal`` counts
    neighbours that are none of su, ua, au. Rows with a null conv_id are one
    conversation. Other columns are not read. An empty table gives an empty
    result. A digest of a conversation has to read its rows in order, so one
    task reads each conversation, holding no more of it than a batch.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dropped = F.lit(False) if mark_column is None else F.coalesce(F.col(mark_column), F.lit(False))
    rows = chats.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), blank("role").alias("role"), blank("text").alias("text"),
        dropped.alias("dropped"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("fault", fault(F.row_number().over(same) > 1))
    again = F.coalesce(F.col("fault") == "duplicate", F.lit(False))
    ordered = rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", again)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, repair, done = None, None, []

        def out() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [()] * len(names)
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for conv, turn, role, text, gone, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if repair is None or conv != at:
                    if repair is not None:
                        done.append((at, *repair.result()))
                    at, repair = conv, Repair()
                if not gone:
                    repair.add(turn, role, text, found)
            yield out()
            done.clear()
        if repair is not None:
            done.append((at, *repair.result()))
        yield out()

    schema = ", ".join(f"{name} {'bigint' if kind == pa.int64() else 'string'}" for name, kind in zip(names, kinds, strict=True))
    return ordered.select("conv_id", "turn", "role", "text", "dropped", "fault").mapInArrow(run, schema)
