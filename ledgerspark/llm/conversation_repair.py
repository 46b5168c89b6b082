"""Cheapest repair of conversations whose turns are missing, repeated, blank, cut off or under the wrong role.

Turns are dealt by conversation, once, and sorted by turn there; ``mapInArrow`` reads them as one stream. For every
conversation a dynamic program carries, from batch to batch, the cheapest way to each of four states of the pattern
``(s?(ua)+)?``: nothing yet, after the system turn, after a user turn, after an assistant turn. A state that costs
over ``SLACK`` more than the cheapest one can never win again, so the differences of costs, together with the order of
the ways, are finitely many. All steps between them are numbered beforehand, and the number of its step, two bytes, is
all that has to be remembered of a turn. Turns and steps of a conversation over ``SPILL_BYTES`` go to unnamed files in
the folders for Spark's own spills; they are read backwards for the way and forwards for the result, so a task's
memory is bounded whatever the length of a conversation. A task that is lost is run again from its shuffled rows.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What edits cost; an undeleted truncated turn adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: From the cheapest state, whatever another state goes on to do is done for at most this much more: add the other
#: speaker's empty turn and delete a system turn.
SLACK = INSERT + DELETE
#: Bytes of a conversation's turns that stay in memory.
SPILL_BYTES = 16 << 20
#: Turns of one output batch.
OUT_ROWS = 2000

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the next speaker's turn leads, and whose it is.
_NEXT = (USER, USER, ASSISTANT, USER)
_SPEAKER = ("user", "user", "assistant", "user")
KEEP_, REROLE_, DELETE_ = range(3)
_LETTER = "KRD"
#: Faults by number; a turn's kind is four times its initial's place here plus its fault's.
FAULTS = (None, "blank", "duplicate", "truncated")
INITIALS = ("", "s", "u", "a")
_LEGAL = {(1, 2), (2, 3), (3, 2)}


@dataclass(frozen=True)
class Steps:
    """All steps of the dynamic program. By number of a step: the next situation, the cost by which its cheapest
    state grew, and for each state reached the state before it, the turns inserted first, and the edit."""

    of: dict[tuple[int, int], int]
    next: list[int]
    cost: list[int]
    back: list[tuple]
    #: By situation, the state it ends in, the turns inserted at the end, and what that costs over the cheapest state.
    end: list[tuple[int, int, int]]


def _moves(state: int, kind: int) -> Iterator[tuple[int, int, int, int]]:
    """(state after, cost, turns inserted first, edit) for a turn of a kind.

    Turns are never inserted before a deletion: inserted after it they give the same and come later in the audit.
    """
    initial, fault = divmod(kind, 4)
    yield state, DELETE, 0, DELETE_
    if FAULTS[fault] in ("blank", "duplicate"):
        return
    extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
    for inserted in range(3):
        speaker = _NEXT[state]
        if initial == speaker or (initial == SYSTEM and state == START):
            yield (SYSTEM if initial == SYSTEM else speaker), extra + INSERT * inserted, inserted, KEEP_
        yield speaker, extra + REROLE + INSERT * inserted, inserted, REROLE_
        state = speaker


def _step(situation: tuple, kind: int) -> tuple[tuple, int, tuple]:
    """Situation after a turn, growth of the least cost, and the ways back. A situation has, by state, the cost over
    the cheapest one and the rank of the state's audit among those of all states, or None.

    Audits of different states that cover the same turns end in no insertion and differ, so none is a prefix of
    another: what is appended decides only between ways from the same state.
    """
    best: dict[int, tuple] = {}
    for state, known in enumerate(situation):
        if known is None:
            continue
        cost, rank = known
        for after, more, inserted, edit in _moves(state, kind):
            way = (cost + more, rank, "I" * inserted + _LETTER[edit], state, inserted, edit)
            if after not in best or way < best[after]:
                best[after] = way
    least = min(way[0] for way in best.values())
    best = {state: way for state, way in best.items() if way[0] <= least + SLACK}
    ranks = {state: i for i, state in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
    after = tuple((best[s][0] - least, ranks[s]) if s in best else None for s in range(4))
    return after, least, tuple(best[s][3:] if s in best else None for s in range(4))


def _end(situation: tuple) -> tuple[int, int, int]:
    missing = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    ways = [(k[0] + INSERT * missing[s], k[1], missing[s], s) for s, k in enumerate(situation) if k]
    cost, _, inserted, state = min(ways)
    return state, inserted, cost


@lru_cache(maxsize=1)
def steps() -> Steps:
    """The steps from the start on, for all kinds of turns; situation 0 is the start."""
    start = ((0, 0), None, None, None)
    numbers, queue = {start: 0}, [start]
    out = Steps({}, [], [], [], [])
    for situation in queue:
        for kind in range(16):
            after, cost, back = _step(situation, kind)
            if after not in numbers:
                numbers[after] = len(queue)
                queue.append(after)
            out.of[numbers[situation], kind] = len(out.next)
            out.next.append(numbers[after])
            out.cost.append(cost)
            out.back.append(back)
    out.end.extend(_end(s) for s in queue)
    return out


def _spill_file():
    """An unnamed file where Spark puts its own spills; it is gone with the task, whatever becomes of it."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)


class Conversation:
    """A conversation's turns as they come, its figures, and the steps of its repair."""

    def __init__(self, key):
        self.key = key
        self.batches: list[pa.RecordBatch] = []
        self.memory = self.rows = 0
        self.steps: list[np.ndarray] = []
        self.turn_file = self.writer = self.step_file = None
        self.situation, self.cost, self.initial, self.illegal = 0, 0, None, 0
        self.faults = [0] * 4
        self.turns, self.low, self.high = 0, None, None

    def add(self, batch: pa.RecordBatch) -> None:
        known = steps()
        kinds = batch.column("kind").to_pylist()
        numbers = np.empty(len(kinds), np.uint16)
        situation = self.situation
        for i, kind in enumerate(kinds):
            step = numbers[i] = known.of[situation, kind]
            self.cost += known.cost[step]
            situation = known.next[step]
            initial, fault = divmod(kind, 4)
            self.faults[fault] += 1
            if self.initial is not None and (self.initial, initial) not in _LEGAL:
                self.illegal += 1
            self.initial = initial
        self.situation = situation
        for turn in batch.column("turn").to_pylist():
            # Turns come in order, so a new one is above all before it.
            if turn is not None and turn != self.high:
                self.turns, self.high = self.turns + 1, turn
                self.low = turn if self.low is None else self.low
        self.batches.append(batch)
        self.steps.append(numbers)
        self.rows += len(kinds)
        self.memory += batch.nbytes
        if self.memory > SPILL_BYTES:
            self._spill()

    def _spill(self) -> None:
        if self.writer is None:
            self.turn_file, self.step_file = _spill_file(), _spill_file()
            self.writer = pa.ipc.new_stream(self.turn_file, self.batches[0].schema)
        for batch in self.batches:
            self.writer.write_batch(batch)
        for numbers in self.steps:
            self.step_file.write(numbers.tobytes())
        self.batches, self.steps, self.memory = [], [], 0

    def _settle(self) -> int:
        """Replace steps by edits (four times the turns inserted first, plus the edit), last turn first; gives the
        turns inserted at the end."""
        state, inserted, cost = steps().end[self.situation]
        self.cost += cost
        for numbers in reversed(self.steps):
            state = _edits(numbers, state)
        if self.step_file:
            self.step_file.flush()
            to = self.step_file.tell()
            while to:
                at = max(0, to - (2 << 16))
                self.step_file.seek(at)
                numbers = np.frombuffer(self.step_file.read(to - at), np.uint16).copy()
                state = _edits(numbers, state)
                self.step_file.seek(at)
                self.step_file.write(numbers.tobytes())
                to = at
        return inserted

    def _stored(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        if self.writer:
            self.writer.close()
            self.turn_file.seek(0)
            self.step_file.seek(0)
            for batch in pa.ipc.open_stream(self.turn_file):
                yield batch, np.frombuffer(self.step_file.read(2 * batch.num_rows), np.uint16)
        yield from zip(self.batches, self.steps, strict=True)

    def repaired(self) -> Iterator[tuple]:
        """(position, turn, role, text, edit, fault) of all edits in order; deleted turns have no position."""
        at_end = self._settle()
        state, position = START, 0
        for batch, edits in self._stored():
            names = ("turn", "role", "text", "kind")
            for turn, role, text, kind, code in zip(*[batch.column(n).to_pylist() for n in names], edits.tolist(), strict=True):
                inserted, edit = divmod(code, 4)
                for _ in range(inserted):
                    yield position, None, _SPEAKER[state], "", "I", None
                    state, position = _NEXT[state], position + 1
                fault = FAULTS[kind % 4]
                if edit == DELETE_:
                    yield None, turn, role, text, "D", fault
                    continue
                if edit == REROLE_:
                    role = _SPEAKER[state]
                state = SYSTEM if edit == KEEP_ and kind // 4 == SYSTEM else _NEXT[state]
                yield position, turn, role, text, _LETTER[edit], fault
                position += 1
        for _ in range(at_end):
            yield position, None, _SPEAKER[state], "", "I", None
            state, position = _NEXT[state], position + 1

    def figures(self) -> dict:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        _, blank, duplicate, truncated = self.faults
        return {"gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": self.illegal, "cost": self.cost}


def _edits(numbers: np.ndarray, state: int) -> int:
    back = steps().back
    for i in range(len(numbers) - 1, -1, -1):
        state, inserted, edit = back[numbers[i]][state]
        numbers[i] = 4 * inserted + edit
    return state


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Whole conversations of a stream in which each one's turns follow each other."""
    current = None
    for batch in batches:
        keys = batch.column("conv").to_pylist()
        at = 0
        while at < len(keys):
            to = at + 1
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            if current is None or current.key != keys[at]:
                if current is not None:
                    yield current
                current = Conversation(keys[at])
            current.add(batch.slice(at, to - at))
            at = to
    if current is not None:
        yield current


_TURN_FIELDS = "position bigint, turn bigint, role string, text string, edit string, fault string"
_REPORT_FIELDS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _turn_rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = []
    for conversation in _conversations(batches):
        for row in conversation.repaired():
            rows.append((conversation.key, *row))
            if len(rows) >= OUT_ROWS:
                yield _out(rows, schema)
                rows = []
    yield _out(rows, schema)


def _report_rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = []
    for conversation in _conversations(batches):
        digest, audit, first = hashlib.sha256(), [], True
        for position, _, role, text, edit, _ in conversation.repaired():
            audit.append(edit)
            if position is not None:
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        figures = conversation.figures()
        rows.append((conversation.key, *figures.values(), "".join(audit), digest.hexdigest()))
        if len(rows) >= OUT_ROWS:
            yield _out(rows, schema)
            rows = []
    yield _out(rows, schema)


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _stream(turns: DataFrame) -> DataFrame:
    """Turns dealt by conversation and sorted there, with the kind of each; conv, turn, role, text, kind."""
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), blank).alias("role"),
        F.coalesce(F.col("text"), blank).alias("text"),
    ).repartition("conv")
    # Both sorts work on the rows as they are dealt, and Spark spills them.
    seen = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    rows = rows.withColumn("seen", seen)
    kept = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(kept == "", 1)
        .when(F.col("seen") > 1, 2)
        .when(~F.right(kept, F.lit(1)).isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    initial = F.array_position(F.array(*[F.lit(i) for i in INITIALS[1:]]), F.left("role", F.lit(1)))
    kind = (4 * initial + fault).cast("int")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "seen"]
    return rows.sortWithinPartitions(*order).select("conv", "turn", "role", "text", kind.alias("kind"))


def _repair(turns: DataFrame, fields: str, rows) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    key = turns.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key), *T._parse_datatype_string(fields)])
    arrow = to_arrow_schema(schema)
    return _stream(turns).mapInArrow(lambda batches: rows(batches, arrow), schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """Every edit of the cheapest repair, in order: conv_id, position, turn, role, text, edit, fault.

    Turns are ``conv_id, turn, role, text``, in order of turn (nulls first), then role and text. A turn's first fault
    counts: blank (nothing but white space), duplicate (the conversation had role and text before), truncated (the last
    character that is no white space is none of ``.!?``). Edits: Keep (0), Rerole to user or assistant (3), Delete (4;
    the only one for blank and duplicate turns), Insert an empty user or assistant turn (3); an undeleted truncated
    turn adds 3. The cheapest edits that leave roles of initials ``(s?(ua)+)?`` win, of as cheap ones those whose
    letters come first. Rows with edit D have no position; the others, by position, are the repaired conversation.

    A null role or text is one space; turns of a null conv_id are one conversation; a null turn comes first. Repeated
    rows are duplicates. Other columns are not read. An empty table gives no rows.
    """
    return _repair(turns, _TURN_FIELDS, _turn_rows)


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation about the same repair: ``gaps`` in the turn numbers (nulls ignored), turns by fault,
    ``illegal`` neighbouring initials (other than su, ua, au), ``cost``, ``audit`` (letters of all edits), and the
    SHA-256 of the repaired ``role:text`` lines."""
    return _repair(turns, _REPORT_FIELDS, _report_rows)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns as a test damages them, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a turn, 1 empties its text, 2
    removes ``.!?`` from it, 3 repeats it, 4 makes its role user. Nulls are one space; conv_id and turn stay null."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(lot == 1, F.lit("")).when(lot == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(lot == 4, F.lit("user")).otherwise(spaced("role"))
    copies = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = turns.where(lot != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))
    return rows.drop("_copy")


def report_of_all(turns: DataFrame, report: DataFrame) -> DataFrame:
    """The report with a row of zeros for each conversation of ``turns`` that it lacks."""
    ids = turns.select(F.col("conv_id").alias("id")).distinct()
    joined = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    filled = [
        F.coalesce(f.name, empty if f.name == "repaired_sha256" else F.lit("").cast(f.dataType) if f.name == "audit" else F.lit(0)).alias(f.name)
        for f in report.schema
        if f.name != "conv_id"
    ]
    return joined.select(F.col("id").alias("conv_id"), *filled)
