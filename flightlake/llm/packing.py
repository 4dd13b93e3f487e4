"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Only the number of pieces of each length decides a packing, so the plan is
made from the histogram of lengths (at most ``capacity`` rows) and holds runs:
so many sequences of the same combination of lengths. Exact complements come
first: for the longest length left, a single, a pair or a triple of lengths
that fills its gap exactly is looked up and used as often as the counts allow.
What has no exact complement is packed best fit, longest first. The pieces
then find their place in Spark by their rank among the pieces of their length,
so nothing but the histogram and the plan passes through the driver.

Null and empty texts are one piece with the end id alone. Documents longer
than the capacity are cut, no other. Repeated rows are packed each.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, keeps, lean, release, stored

CAPACITY = 4096
END_ID = 1
#: Pieces, and words of other characters, remembered by a Python worker, at least; twice as many at most. A piece
#: takes some 100 to 150 bytes; the merges of one that is forgotten are the largest part of the time.
MEMO_SIZE = 200_000
WORD_MEMO_SIZE = 50_000
#: Parts in which the pieces of one length are ranked.
SHARDS = 64

#: White space of a word split, and text on which lower case and composition are the same for every library.
_SPACE = " \t-\r"
_PLAIN = re.compile(f"[!-~À-ÖØ-öø-įı-ňŊ-ž{_SPACE}]*")
_LETTER = "a-zß-öø-ž"
_PIECE = re.compile(f"[{_LETTER}]++|'(?:[stmd]|re|ve|ll)|[0-9]|[^0-9{_LETTER}{_SPACE}]++")
_WORD = re.compile(f"[^{_SPACE}]+")
_BREAK = re.compile(f"[{_SPACE}]")
#: Characters that are split at once.
_SLICE = 1 << 16


class WordIds:
    """Ids of whole texts by a tokenizer that lower-cases and drops white
    space: no token crosses white space. Plain text is cut into pieces, which go
    straight to the tokenizer's merge model and are remembered; words of other
    characters go through the whole tokenizer."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        #: The byte alphabet: printable bytes as they are, others from 256 on.
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(hidden)} | {b: chr(b) for b in shown}
        self.pieces = Memo(self._piece, MEMO_SIZE)
        self.words = Memo(self._word, WORD_MEMO_SIZE)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(word.lower())))
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        out, at = [], 0
        while at < len(text):
            cut = _BREAK.search(text, at + _SLICE)
            part = text[at:cut.start()] if cut else text[at:]
            at += len(part)
            if _PLAIN.fullmatch(part):
                out.append(b"".join(map(self.pieces.__getitem__, _PIECE.findall(part.lower()))))
            else:
                out.append(b"".join(map(self.words.__getitem__, _WORD.findall(part))))
        return b"".join(out)


@functools.cache
def word_ids(tokenizer_path: str) -> WordIds:
    made = WordIds(tokenizer_path)
    release()  # what reading the file took
    return made


keeps(word_ids.cache_clear)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of ``docs``."""
    def run(batches):
        ids_of, last = word_ids(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows = ([], [], [], [], [])
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = ids_of(text.as_py() or "") + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for to, x in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        to.append(x)
            kinds = (b.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _pair(counts: np.ndarray, gap: int, most: int) -> tuple[int, ...] | None:
    """The pair of available lengths with sum ``gap`` whose longer one is
    longest, up to ``most``."""
    lo, hi = -(-gap // 2), min(gap - 1, most)
    if hi < lo:
        return None
    both = np.flatnonzero((counts[lo:hi + 1] > 0) & (counts[gap - hi:gap - lo + 1][::-1] > 0))
    for k in both[::-1]:
        x = lo + int(k)
        if x != gap - x or counts[x] > 1:
            return x, gap - x
    return None


def _complement(counts: np.ndarray, gap: int, most: int) -> tuple[int, ...] | None:
    """One, two or three available lengths, none over ``most``, that sum to ``gap``."""
    if gap <= most and counts[gap] > 0:
        return (gap,)
    if two := _pair(counts, gap, most):
        return two
    for a in np.flatnonzero(counts[:min(gap - 1, most + 1)])[::-1].tolist():
        if 3 * a < gap:
            return None  # the longest of three is at least a third
        counts[a] -= 1
        two = _pair(counts, gap - a, a)
        counts[a] += 1
        if two:
            return a, *two
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """``(sequences, lengths)`` runs that use every piece of the histogram
    ``counts`` once. No sum of lengths is over the capacity."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    runs: list[tuple[int, tuple[int, ...]]] = []
    for length in range(capacity, 0, -1):
        while left[length] > 0:
            left[length] -= 1
            gap = capacity - length
            found = _complement(left, gap, min(length, gap)) if gap else ()
            left[length] += 1
            if found is None:
                break
            used = (length, *found)
            n = min(int(left[x]) // used.count(x) for x in set(used))
            for x in used:
                left[x] -= n
            runs.append((n, used))
    # Best fit, longest first, over groups of sequences with the same content.
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fit = min((r for r in room if r >= length), default=None)
            if fit is None:
                fit, open_n, content = capacity, n, ()
            else:
                open_n, content = room[fit].pop()
                if not room[fit]:
                    del room[fit]
            each = min(fit // length, n)  # a started sequence stays the best fit while it has room
            take = min(open_n, n // each)
            if content and take < open_n:
                room.setdefault(fit, []).append((open_n - take, content))
            room.setdefault(fit - each * length, []).append((take, content + (length,) * each))
            n -= take * each
    return runs + [x for groups in room.values() for x in groups]


def places(runs: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """One row a slot of a run, sorted: length, first rank of that length that
    goes there, first sequence, offset."""
    rows, taken, first = [], {}, 0
    for n, lengths in runs:
        offset = 0
        for x in lengths:
            rows.append((x, taken.get(x, 0), first, offset))
            taken[x] = taken.get(x, 0) + n
            offset += x
        first += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of ``docs(doc_id, text)`` with its ``sequence_id`` and its
    ``offset`` there."""
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    by = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SHARDS)).cast("int"))
    sizes = by.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))  # at most capacity x SHARDS rows
    starts = sizes.select("length", "shard", (F.sum("n").over(
        Window.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = places(plan(counts, capacity))
    wide = 1 << 44
    keys = slots[:, 0] * wide + slots[:, 1]
    ranked = by.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    placed = ranked.join(starts, ["length", "shard"]).withColumn("rank", F.col("rank") + F.col("before"))

    def run(batches):
        for b in batches:
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, b.column("length").to_numpy(zero_copy_only=False) * wide + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3])],
                names=[*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = dict(docs.dtypes)["doc_id"]
    return placed.select(*kept, "rank").mapInArrow(lean(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
