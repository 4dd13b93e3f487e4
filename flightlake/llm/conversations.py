"""Conversation structure repair: the cheapest edits that give every
conversation the roles ``(s?(ua)+)?``.

Rows are dealt by conversation and sorted by turn (nulls first; ties by role,
text and then number among equals), and one task streams through a
conversation, with the state of a dynamic program carried across Arrow batches:
for each of four automaton states (nothing yet, after a system turn, after a
user, after an assistant) the least cost and the order of the edit strings that
reach them. Two strings that reach a row are never prefixes of one another, so
these orders decide all ties, and a row costs one pointer of four bytes,
whatever the texts are.

A conversation of up to ``GIANT`` rows and ``GIANT_CHARS`` characters is held,
traced back and repaired at once. Of a larger one no text is held: its pointers
leave the task as blocks of a table in the shared folder, are traced back block
by block in descending order, and the pieces meet the sorted rows again, each
before the first row that it is for.

Faults, the first that holds: ``blank`` (no character but ASCII white space),
``duplicate`` (role and text seen earlier in the conversation), ``truncated``
(the last such character is none of ``.!?``). Edits: keep (K, 0), rerole to
user or assistant (R, 3), delete (D, 4; blank and duplicate rows must go),
insert an empty turn of a user or assistant (I, 3); a truncated row that stays
adds 3. Of the cheapest, the first by ASCII of their initials is taken.

Null ids are one conversation; null roles and texts are one space; null turns
come first. A role counts by its first character. Columns beyond the four are
not read. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

REROLE = INSERT = TRUNCATED = 3
DELETE = 4
#: Rows and characters of a conversation that a task holds, and pointers of a block.
GIANT = 20_000
GIANT_CHARS = 4_000_000
BLOCK = 65_536
#: Rows and characters of a frame handed on.
_ROWS = 2_000
_CHARS = 1_000_000

_SPACE = " \t\n\x0b\x0c\r"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: What an edit before a row may be, in ASCII order: inserts, then the row's own.
_MOVES = ("D", "IIK", "IIR", "IK", "IR", "K", "R")
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_FAR = 1 << 60

#: Edits of repaired conversations, and blocks of pointers of giant ones under the key of their first row.
_EDITS = ("conv_id string, step long, edit string, turn string, role string, text string, was string, fault string, "
          "nth long, pointers binary, state int, tail int")
_EDIT_NAMES = [c.split()[0] for c in _EDITS.split(", ")]
_KEPT = [c for c in _EDITS.split(", ") if c.split()[0] not in ("edit", "was", "fault")]
_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SUMMARY_NAMES = [c.split()[0] for c in _SUMMARY.split(", ")]


def _next(state: int) -> int:
    """State after a turn of the role that is due."""
    return _ASSISTANT if state == _USER else _USER


def _moves(state: int, initial: str, must_go: bool, truncated: bool):
    """``(new state, cost, place in _MOVES)`` for a row."""
    for m, move in enumerate(_MOVES):
        at, cost = state, 0
        for _ in range(move.count("I")):
            at, cost = _next(at), cost + INSERT
        if move[-1] == "D":
            yield at, DELETE, m
        elif not must_go:
            cost += TRUNCATED * truncated
            due = _next(at)
            if move[-1] == "R":
                yield due, cost + REROLE, m
            elif initial == _ROLE[due][0]:
                yield due, cost, m
            elif initial == "s" and at == _START:
                yield _SYSTEM, cost, m


_TABLE = {(i, g, t): [list(_moves(s, i, g, t)) for s in range(4)]
          for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


class Path:
    """Costs and orders of the four states, and the rows' pointers."""

    def __init__(self):
        self.cost = [0, _FAR, _FAR, _FAR]
        self.order = [0, 0, 0, 0]
        self.pointers = array("I")

    def add(self, initial: str, fault: str | None) -> None:
        best: list = [None] * 4
        for state, moves in enumerate(_TABLE[initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"),
                                             fault == "truncated"]):
            so_far, order = self.cost[state], self.order[state]
            if so_far < _FAR:
                for to, cost, m in moves:
                    way = (so_far + cost, order, m, state)
                    if best[to] is None or way < best[to]:
                        best[to] = way
        pointer = 0
        strings = sorted({(w[1], w[2]) for w in best if w})
        for to, w in enumerate(best):
            self.cost[to] = w[0] if w else _FAR
            if w:
                self.order[to] = strings.index((w[1], w[2]))
                pointer |= (w[2] * 4 + w[3]) << (5 * to)
        self.pointers.append(pointer)

    def end(self) -> tuple[int, int]:
        """Last state and the inserts behind the last row."""
        ways = [(self.cost[s] + INSERT * k, self.order[s], k, s)
                for s, k in ((_START, 0), (_ASSISTANT, 0), (_USER, 1), (_SYSTEM, 2)) if self.cost[s] < _FAR]
        _, _, k, s = min(ways)
        return s, k


def trace(pointers: array, state: int) -> tuple[bytearray, int]:
    """Moves of the rows of ``pointers`` that end in ``state``, and the state
    before the first of them."""
    moves = bytearray(len(pointers))
    for i in range(len(pointers) - 1, -1, -1):
        p = pointers[i] >> (5 * state) & 31
        moves[i], state = p >> 2, p & 3
    return moves, state


def fault_of(text: str, nth: int) -> str | None:
    end = text.rstrip(_SPACE)
    return "blank" if not end else "duplicate" if nth > 1 else None if end[-1] in ".!?" else "truncated"


class _Repair:
    """Edit rows of one conversation, from its rows and their moves."""

    def __init__(self, conv):
        self.conv, self.step, self.state = conv, 0, _START

    def _row(self, edit, turn, role, text, was, fault):
        self.step += 1
        return (self.conv, self.step - 1, edit, turn, role, text, was, fault, None, None, None, None)

    def insert(self):
        self.state = _next(self.state)
        return self._row("I", None, _ROLE[self.state], "", None, None)

    def rows(self, move: int, turn, role, text, fault):
        *inserts, edit = _MOVES[move]
        for _ in inserts:
            yield self.insert()
        if edit != "D":
            self.state = _SYSTEM if edit == "K" and self.state == _START and role[:1] == "s" else _next(self.state)
        yield self._row(edit, turn, _ROLE[self.state] if edit == "R" else role, text, role, fault)


def _frames(rows, names):
    """Rows as frames of bounded size."""
    held, chars = [], 0
    text = names.index("text")
    for r in rows:
        held.append(r)
        chars += len(r[text] or "")
        if len(held) >= _ROWS or chars > _CHARS:
            yield pd.DataFrame(held, columns=names, dtype=object)
            held, chars = [], 0
    if held:
        yield pd.DataFrame(held, columns=names, dtype=object)


def _rows(frames, names):
    for f in frames:
        yield from zip(*(f[c].tolist() for c in names))


def _conversations(rows):
    """Runs of rows with one id: ``(id, rows)``."""
    return groupby(rows, key=lambda r: r[0])


def _solve(giant: int, giant_chars: int, block: int):
    """Edits of each conversation; of a giant one, its pointers."""

    def of_conversation(conv, rows):
        path, held, chars, spilled, blocks, key = Path(), [], 0, False, 0, None

        def pointers(state, tail):
            nonlocal blocks
            turn, role, text, nth = key
            out = (conv, blocks, None, turn, role, text, None, None, nth, path.pointers.tobytes(), state, tail)
            path.pointers, blocks = array("I"), blocks + 1
            return out

        for _, turn, role, text, nth, absent in rows:
            if absent:
                continue
            fault = fault_of(text, nth)
            if len(path.pointers) == block and spilled:
                yield pointers(None, None)
            if not path.pointers:
                key = (turn, role, text, nth)
            path.add(role[:1], fault)
            if not spilled:
                held.append((turn, role, text, fault))
                chars += len(text)
                if len(held) > giant or chars > giant_chars:
                    spilled, held = True, None
        if spilled:
            yield pointers(*path.end())
            return
        if not held:
            yield (conv, 0, *[None] * 10)  # only named
            return
        state, tail = path.end()
        repair = _Repair(conv)
        for move, row in zip(trace(path.pointers, state)[0], held):
            yield from repair.rows(move, *row)
        for _ in range(tail):
            yield repair.insert()

    def run(frames):
        edits = (e for conv, rows in _conversations(_rows(frames, ["conv_id", "turn", "role", "text", "nth", "absent"]))
                 for e in of_conversation(conv, rows))
        yield from _frames(edits, _EDIT_NAMES)

    return run


def _trace_back(frames):
    """Blocks of pointers, the last of a conversation first, as moves."""
    conv, state = object(), 0
    for f in frames:
        out = f.copy()
        for i, (c, p, last) in enumerate(zip(f["conv_id"], f["pointers"], f["state"])):
            if c != conv:
                conv, state = c, int(last)
            moves, state = trace(array("I", p), state)
            out.iat[i, out.columns.get_loc("pointers")] = bytes(moves)
        yield out


def _apply(frames):
    """Edits of giant conversations, from sorted rows and, before the first row
    of each block, its moves."""

    def of_conversation(conv, rows):
        repair, moves, tail = _Repair(conv), iter(()), 0
        for _, turn, role, text, nth, absent, pointers, last in rows:
            if pointers is not None:
                moves, tail = iter(pointers), 0 if last is None or last != last else int(last)
            elif not absent:
                yield from repair.rows(next(moves), turn, role, text, fault_of(text, nth))
        for _ in range(tail):
            yield repair.insert()

    names = ["conv_id", "turn", "role", "text", "nth", "absent", "pointers", "tail"]
    yield from _frames((e for conv, rows in _conversations(_rows(frames, names)) for e in of_conversation(conv, rows)), _EDIT_NAMES)


def _summaries(frames):
    """One row a conversation from its edits; blocks of pointers pass."""
    names = [*_SUMMARY_NAMES, *(c.split()[0] for c in _KEPT)]

    def of_conversation(conv, rows):
        count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        illegal, cost, audit, sha, lines = 0, 0, bytearray(), hashlib.sha256(), 0
        low, turns, last, before = None, 0, None, None
        for (_, step, edit, turn, role, text, was, fault, *block) in rows:
            if block[1] is not None:
                yield (*[None] * len(_SUMMARY_NAMES), conv, step, turn, role, text, *block)
                continue
            if edit is None:
                continue
            audit += edit.encode()
            if edit != "I":
                if turn is not None and (t := int(turn)) != last:
                    low, turns, last = t if low is None else low, turns + 1, t
                if before is not None and before + was[:1] not in ("su", "ua", "au"):
                    illegal += 1
                before = was[:1]
                if fault:
                    count[fault] += 1
            cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
            if edit != "D":
                sha.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1
        if block[1] is None:
            gaps = 0 if low is None else (last - low + 1 - turns + 2 ** 63) % 2 ** 64 - 2 ** 63
            yield (gaps, *count.values(), illegal, cost, audit.decode(), sha.hexdigest(), conv, *[None] * (len(_KEPT) - 1))

    yield from _frames((s for conv, rows in _conversations(_rows(frames, _EDIT_NAMES)) for s in of_conversation(conv, rows)), names)


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in ("conv_id", "at", "role", "text", "nth", "kind")))


def _dealt(conversations: DataFrame, absent: str | None) -> DataFrame:
    """Rows by conversation, numbered among those of equal role and text."""
    own = conversations.select(
        F.col("conv_id").cast("string"), F.col("turn").alias("at"), F.col("turn").cast("string").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)).alias("absent"))
    alike = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("absent"), F.col("at").asc_nulls_first())
    return own.repartition("conv_id").withColumn("nth", F.row_number().over(alike).cast("long")).withColumn("kind", F.lit(1))


def _with_giants(conversations: DataFrame, absent: str | None, then, giant: int, giant_chars: int, block: int) -> DataFrame:
    """``then`` over the edits of all conversations, each whole and in order."""
    rows = _dealt(conversations, absent)
    first = _sorted(rows).mapInPandas(_solve(giant, giant_chars, block), _EDITS)
    first = stored(then(first), "conversations")
    blocks = first.where("pointers is not null")
    held = first.where("pointers is null")
    if blocks.isEmpty():
        return held
    key = "conv_id string, step long, turn string, role string, text string, nth long, pointers binary, state int, tail int"
    blocks = blocks.select(*(c.split()[0] for c in key.split(", ")))
    traced = stored(blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("step"))
                    .mapInPandas(_trace_back, key), "moves")
    of_giants = rows.join(blocks.select(F.col("conv_id").alias("_giant")).distinct(), F.col("conv_id").eqNullSafe(F.col("_giant")), "left_semi")
    turn = conversations.schema["turn"].dataType
    pieces = traced.select("conv_id", F.col("turn").cast(turn).alias("at"), "turn", "role", "text", F.lit(False).alias("absent"),
                           "nth", F.lit(0).alias("kind"), "pointers", "tail")
    both = of_giants.withColumn("pointers", F.lit(None).cast("binary")).withColumn("tail", F.lit(None).cast("int")).unionByName(pieces)
    edits = _sorted(both.repartition("conv_id")).mapInPandas(_apply, _EDITS)
    return held.unionByName(then(edits))


def repair(conversations: DataFrame, absent: str | None = None, giant: int = GIANT, giant_chars: int = GIANT_CHARS,
           block: int = BLOCK) -> DataFrame:
    """The edits of ``conversations(conv_id, turn, role, text)``: ``conv_id,
    step`` (from 0 in each conversation), ``edit`` (K, R, D or I), ``turn, role,
    text`` as repaired (of a deleted row, as they were; of an inserted one, no
    turn), ``old_role`` and ``fault``. Rows whose column ``absent`` is true only
    name their conversation; one of such rows alone gives one row without edit."""
    out = _with_giants(conversations, absent, lambda edits: edits, giant, giant_chars, block)
    return out.select(F.col("conv_id").cast(conversations.schema["conv_id"].dataType), "step", "edit",
                      F.col("turn").cast(conversations.schema["turn"].dataType), "role", "text", F.col("was").alias("old_role"), "fault")


def summary(conversations: DataFrame, absent: str | None = None, giant: int = GIANT, giant_chars: int = GIANT_CHARS,
            block: int = BLOCK) -> DataFrame:
    """One row for each conversation: its gaps in turns, faults, illegal
    neighbours, cost, audit (initials of the edits) and the SHA-256 of the
    repaired ``role:text`` lines."""
    schema = _SUMMARY + ", " + ", ".join(_KEPT)
    out = _with_giants(conversations, absent, lambda edits: edits.mapInPandas(_summaries, schema), giant, giant_chars, block)
    return out.select(F.col("conv_id").cast(conversations.schema["conv_id"].dataType), *_SUMMARY_NAMES)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the crc32 of their place, ``absent`` where dropped."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    own = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                               (F.crc32(name.cast("binary")) % 20).alias("kind"))
    return own.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").when(F.col("kind") > 0, F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).when(F.col("kind") > 0, F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("absent"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
