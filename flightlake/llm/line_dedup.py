"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z as a-z). Two lines match when the Jaccard
similarity of their sets is 0.8 or more; a line goes if it matches a line
before it, by (doc_id, line number), in the input. Every line that has a word
is compared; with ``min_words``, those of at least so many.

1. Words are ordered by rarity: the frequent ones by their counts, a table of
   bounded size, and before them all others, by hash. Any fixed order gives the
   same result; the rarer the first words, the fewer candidates.
2. Two matching sets share one of the rarest ``n - ceil(0.8 n) + 1`` words of
   either (prefix). The lines of one such word meet, copies of a set as its
   first line, and pairs are kept that their sizes (length filter), the words'
   places (positional filter) and the parity bitmaps of the sets allow: the
   bits that differ are no more than the words that differ. Sets of at most
   ``SHORT`` words match only if equal, and meet under the hash of the set.
   Copies in a block of texts are known there and meet nothing any more.
3. A line names the nearest of its earlier candidates, ``NAMED`` at most in one
   word's group. No more are held; groups with such lines come back as cells.
   The ``NEAREST`` of each group are verified first, on the words themselves:
   nearly all lines that go match one of them, and the pairs then follow the
   lines, not the lines times their copies. Lines without a match have the
   others they named verified; those that still have none then name all their
   candidates in groups with more.
4. Groups of more than ``GROUP`` lines, and those looked at again, are dealt into
   tiles; a task has two tiles of one word, so each pair meets in one task.

A repeated set in a word's group is known by its bitmap, its size and a part of
its hash, all equal, and goes without a look at the words. Null and empty texts
have no lines to compare; texts and lines of any length are taken whole.
Repeated rows have the same (doc_id, line) and repeat nothing by themselves:
such rows keep the same lines. Rows with a null ``doc_id`` stay as they are.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, lean, packed, stored, unpacked

#: ``min_words`` by default: all lines but those without words are compared.
EVERY = 1
#: Words of the sets that match only their equals: four of five words are alike enough.
SHORT = 3
#: Jaccard threshold in percent.
PERCENT = 80
#: Words that are ordered by their counts, at most.
RANKED = 1 << 17
#: Candidates that a line names in one word's group at first.
NAMED = 32
#: Candidates of a line in one word's group that are verified before the others.
NEAREST = 1
#: Cells, and bytes of text, of a block.
BLOCK = 1 << 18
TEXT_BLOCK = 3 << 19
#: The words' cells are dealt out in so many parts at least, those of a block and part in one row.
PARTS = 1 << 12
#: Lines of one word that meet in one task; above, so many in a tile, about.
GROUP = 1 << 13
#: Bits of a table of documents to be fetched, and those in one of its rows.
ASKED = 1 << 25
_PART = 1 << 15
#: Pairs held at once beyond the nearest, and pairs looked at in one step.
_PAIRS = 1 << 19
_STEP = 1 << 14


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x.view(np.uint64) ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_size(n):
    return n - -(-PERCENT * n // 100) + 1


#: Bytes of a word that are hashed eight at a time; longer ones are hashed one by one.
_LONG = 64
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _space(text: np.ndarray) -> np.ndarray:
    return (text - np.uint8(9) < 5) | (text == 32)  # 0 to 8 wrap around


def word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, start)`` of each word of ``text``, A-Z as a-z: bytes of which the
    last is white space."""
    space = _space(text)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.r_[0, edge]
    start, end = edge[::2], edge[1::2]
    size, low = end - start, text.tobytes().lower() + bytes(8)
    eight = np.ndarray(len(text) + 1, "<u8", low, strides=(1,))  # the bytes from each place on
    h = _mix((eight[start] & _FIRST[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), 4)
    for at in range(8, _LONG, 8):
        more = np.flatnonzero(size > at)
        if not len(more):
            break
        h[more] = _mix(h[more] ^ (eight[start[more] + at] & _FIRST[np.minimum(size[more] - at, 8)]), 4)
    for k in np.flatnonzero(size > _LONG).tolist():
        h[k] = int.from_bytes(blake2b(memoryview(low)[start[k]:end[k]], digest_size=8).digest(), "little")
    return h.view(np.int64), start


def text_blocks(batches):
    """``(hash, line, doc, begin, number)`` of the texts, about ``TEXT_BLOCK``
    bytes at a time: the words and the line of each in the block; the documents,
    or parts of one, the line where each begins in the block, and the number
    that this line has in its document. Texts are cut between lines."""
    def block():
        text = np.frombuffer(b"".join(x[3] for x in parts), np.uint8)
        h, start = word_hashes(text)
        words = np.searchsorted(start, np.flatnonzero(text == 10))  # before the end of each line
        return h, np.repeat(np.arange(len(words)), np.diff(words, prepend=0)), *(np.array([x[k] for x in parts], np.int64) for k in range(3))

    parts, lines, size = [], 0, 0
    for b in batches:
        for doc, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
            if not t.is_valid or doc is None:
                continue
            text, at, number = t.as_buffer().to_pybytes() + b"\n", 0, 0
            while at < len(text):
                end = len(text)
                if end - at > TEXT_BLOCK:
                    end = (text.rfind(b"\n", at, at + TEXT_BLOCK) + 1) or (text.index(b"\n", at + TEXT_BLOCK) + 1)
                part = text[at:end]
                parts.append((doc, lines, number, part))
                n = part.count(b"\n")
                lines, number, at, size = lines + n, number + n, end, size + len(part)
                if size >= TEXT_BLOCK:
                    yield block()
                    parts, lines, size = [], 0, 0
    if parts:
        yield block()


def rarity(texts: DataFrame, ranked: int = RANKED) -> np.ndarray:
    """Hashes of the most frequent words, at most ``ranked``, rarest first. A
    word adds to its count where a block holds it twice."""
    def total(held):
        h, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        n = np.zeros(len(h), np.int64)
        np.add.at(n, at, np.concatenate([n for _, n in held]))
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "c"])

    def run(batches):
        held, size = [], 0
        for words, *_ in text_blocks(batches):
            h, n = np.unique(words, return_counts=True)
            held.append((h[n > 1], n[n > 1]))
            size += len(held[-1][0])
            if size >= BLOCK:
                yield total(held)
                held, size = [], 0
        if held:
            yield total(held)

    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = stored(texts.mapInArrow(lean(run), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    power = F.floor(F.log2("c")).cast("int")
    by_power = sorted(words.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)  # at most 64 rows
    least, n = 64, 0
    for p, m in by_power:
        if n + m > ranked:
            break
        least, n = p, n + m
    rows = words.where(power >= least).collect()  # at most ``ranked`` rows
    return np.array([h for _, h in sorted((r.c, r.h) for r in rows)], np.int64)


class Keys:
    """Order keys of words by their hashes: ranked words count up from 0, all
    others have keys below 0."""

    def __init__(self, ranks: np.ndarray):
        # Ranked words by the first bits of their hashes, eight drawers a word.
        bits = int(len(ranks)).bit_length() + 3
        self.shift = np.uint64(64 - bits)
        drawer = (ranks.view(np.uint64) >> self.shift).view(np.int64)
        order = np.argsort(drawer, kind="stable")
        self.first = np.r_[0, np.cumsum(np.bincount(drawer, minlength=1 << bits))].astype(np.int32)
        order = np.r_[order, order[:1]]  # after the last drawer, a word that belongs to another
        self.rank, self.hashes = order, ranks[order]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = h | np.int64(-(1 << 63))  # 63 bits of the hash, below 0
        if not len(self.rank):
            return out
        drawer = (h.view(np.uint64) >> self.shift).view(np.int64)
        at = self.first[drawer]
        same = self.hashes[at] == h
        out = np.where(same, self.rank[at], out)
        of = np.flatnonzero(~same)
        at, end = at[of] + 1, self.first[drawer[of] + 1]
        while True:
            left = at < end
            at, end, of = at[left], end[left], of[left]
            if not len(of):
                return out
            same = self.hashes[at] == h[of]
            out[of[same]] = self.rank[at[same]]
            at, end, of = at[~same] + 1, end[~same], of[~same]


class Block:
    """Lines, given as the hashes of all their words and the line of each, in
    order from 0 without gaps, as sorted sets of word keys."""

    def __init__(self, keys: Keys, words: np.ndarray, line: np.ndarray):
        k = keys(words)
        lines = int(line[-1]) + 1
        order = None
        if lines < 1 << 17:  # line, and the first bits of the key, as one number
            short = np.where(k < 0, (k & np.int64((1 << 63) - 1)) >> 18, k + (1 << 45)) | (line << 46)
            order = np.argsort(short)
            a, c = order[1:], order[:-1]
            if ((short[a] == short[c]) & (k[a] != k[c])).any():
                order = None
        if order is None:
            order = np.lexsort((k, line))
        k, line = k[order], line[order]
        once = np.r_[True, (k[1:] != k[:-1]) | (line[1:] != line[:-1])]
        self.keys, self.line = k[once], line[once]
        self.n = np.bincount(self.line, minlength=lines)
        self.start = np.cumsum(self.n) - self.n
        mixed = _mix(self.keys, 1)
        self.sig = np.add.reduceat(mixed, self.start)
        flip = np.uint64(1) << (mixed & np.uint64(63))
        low = (mixed & np.uint64(64)) == 0
        self.bits = [np.bitwise_xor.reduceat(flip * side, self.start).view(np.int64) for side in (low, ~low)]

    def prefixes(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index, place)`` of the prefix words of the lines ``whole``, and of
        the first word of all others."""
        size = np.where(whole, prefix_size(self.n), 1)
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(self.start, size) + place, place


#: Bits of the packed size and place of a cell, and of what is left of the set's hash.
_BITS = 20
_MOST = (1 << _BITS) - 1
_CELL = ["word", "doc_id", "line", "low", "high", "packed"]
#: For ``packed``: a line that repeats the set of an earlier one, for certain.
_COPY = -1


def cells(docs: DataFrame, ranks, min_words: int) -> DataFrame:
    """A cell for each prefix word of each line's set: the word's key, the line,
    the parity bitmap, and packed the set's size, the word's place and a part
    of the set's hash. A block's copies of a set give one cell, ``_COPY``. The
    words are dealt into parts; ``part, cells`` (binary, ``_CELL`` after
    ``_CELL``) has those of a block and part."""
    least = max(min_words, 1)
    parts = max(PARTS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = np.uint16 if parts <= 1 << 16 else np.int32

    def run(batches):
        keys = Keys(ranks.value)
        for words, at, own, begin, number in text_blocks(batches):
            size = np.bincount(at)
            use = size[at] >= least
            words, at = words[use], at[use]
            if not len(words):
                continue
            whole = np.flatnonzero(size >= least)
            x = Block(keys, words, (np.cumsum(size >= least) - 1)[at])
            part = np.searchsorted(begin, whole, "right") - 1
            doc, line = own[part], number[part] + whole - begin[part]
            order = np.lexsort((line, doc, x.sig))
            new = np.r_[True, x.sig[order][1:] != x.sig[order][:-1]]
            first = np.zeros(len(doc), bool)
            first[order] = new
            head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            again = order[((doc[order] != doc[head]) | (line[order] != line[head])) & (x.n[order] >= min_words)]
            at, place = x.prefixes(first)
            of = x.line[at]
            use = first[of] & (x.n[of] >= min_words)
            at, place, of = at[use], place[use], of[use]
            word = np.where(x.n[of] <= SHORT, x.sig.view(np.int64)[of], x.keys[at])
            packed_ = (np.minimum(x.n, _MOST)[of] << 44) | (np.minimum(place, _MOST) << 24) | (x.sig >> np.uint64(40)).astype(np.int64)[of]
            none = np.zeros(len(again), np.int64)
            apart = _mix(doc[again] * 1_000_003 + line[again], 2).view(np.int64)  # copies go to any task
            rows = np.stack([np.concatenate(c) for c in (
                (word, apart), (doc[of], doc[again]), (line[of], line[again]), (x.bits[0][of], none), (x.bits[1][of], none),
                (packed_, none + _COPY))], axis=1)
            dealt = (((_mix(rows[:, 0], 8) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(kind)
            order = np.argsort(dealt, kind="stable")
            for k in range(0, len(order), BLOCK):
                of = order[k:k + BLOCK]
                part = dealt[of]
                starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                offsets = (np.r_[starts, len(of)] * rows.itemsize * len(_CELL)).astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(rows[of])])
                yield pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), held], names=["part", "cells"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "part int, cells binary")


def _copies(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``again``: the rows of a set that an earlier row of the word has, and the
    indices of those that are the first word of another line."""
    word, bits = c["word"], c["packed"]
    n, place, part = bits >> 44, (bits >> 24) & _MOST, bits & ((1 << 24) - 1)
    # Equal rows stand together by one hash; others between them would only leave a copy to be compared.
    key = _mix(c["low"], 5) ^ c["high"].view(np.uint64)
    key = _mix(key, 6) ^ ((n << 24) | part).view(np.uint64)
    key, bits = _mix(key, 7) ^ word.view(np.uint64), np.uint64(len(word).bit_length())
    same = np.sort((key >> bits << bits) | np.arange(len(word), dtype=np.uint64))
    same = (same & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    again = np.zeros(len(word), bool)
    again[same[1:]] = True
    for k in (word, n, part, c["low"], c["high"]):
        again[same[1:]] &= k[same[1:]] == k[same[:-1]]
    head = same[np.maximum.accumulate(np.where(again[same], 0, np.arange(len(same))))]
    other = (c["doc_id"][same] != c["doc_id"][head]) | (c["line"][same] != c["line"][head])  # not of a repeated row
    return again, same[again[same] & other & (place[same] == 0)]


def _possible(c: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray):
    """The pairs of the rows ``i`` and ``j`` of one word that can match, and how
    many bits of their bitmaps differ."""
    n, place = c["packed"] >> 44, (c["packed"] >> 24) & _MOST
    # Length; then the words before and after the shared one; then the bitmaps.
    ok = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * PERCENT
    a, b = i[ok], j[ok]
    least = -(-PERCENT * (n[a] + n[b]) // (100 + PERCENT))
    reach = np.minimum(place[a], place[b]) + np.minimum(n[a] - place[a], n[b] - place[b])
    huge = np.maximum(n[a], n[b]) == _MOST  # size and place were cut
    ok = (reach >= least) | huge
    a, b, least, huge = a[ok], b[ok], least[ok], huge[ok]
    low, high = c["low"].view(np.uint64), c["high"].view(np.uint64)
    apart = np.bitwise_count(low[a] ^ low[b]) + np.bitwise_count(high[a] ^ high[b])
    ok = (apart <= n[a] + n[b] - 2 * least) | huge
    return a[ok].astype(np.int32), b[ok].astype(np.int32), apart[ok].astype(np.uint8)


class Nearest:
    """Pairs ``(earlier, later, apart)``; of one later row the ``most`` nearest
    are held, or all if ``most`` is None."""

    def __init__(self, most: int | None):
        self.most, self.found, self.size, self.room = most, [], 0, _PAIRS

    def add(self, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> None:
        if len(a):
            self.found.append((a, b, apart))
            self.size += len(a)
            if self.most is not None and self.size > self.room:
                self.found = [self.pairs()]
                self.size = len(self.found[0][0])
                self.room = 2 * self.size + _PAIRS

    def pairs(self):
        """By later row, the nearest first."""
        if not self.found:
            return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint8)
        a, b, apart = (np.concatenate(x) for x in zip(*self.found))
        by = np.lexsort((a, apart, b))
        a, b, apart = a[by], b[by], apart[by]
        if self.most is not None:
            at = np.arange(len(b))
            keep = at - np.maximum.accumulate(np.where(np.r_[True, b[1:] != b[:-1]], at, 0)) < self.most
            a, b, apart = a[keep], b[keep], apart[keep]
        return a, b, apart

    def lists(self):
        """``(later, counts, earlier)``."""
        a, b, _ = self.pairs()
        starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.empty(0, int)
        return b[starts], np.diff(np.r_[starts, len(b)]), a


def candidates(c: dict[str, np.ndarray], most: int | None = None):
    """``(copies, later, counts, earlier)`` rows in the cells of whole words,
    which come by word and line. ``copies``: first words of sets that an earlier
    line has. ``later``: lines with candidates, ``counts`` of them, which stand
    in ``earlier`` one line's after the other's, the nearest first, ``most`` of
    them at most."""
    again, copies = _copies(c)
    order = np.flatnonzero(~again)
    c = {k: v[order] for k, v in c.items()}
    # In a word's group by size, the sizes that a line allows stand together.
    n, group = c["packed"] >> 44, np.cumsum(np.r_[True, c["word"][1:] != c["word"][:-1]][:len(order)])
    size = (group << _BITS) | n
    by = np.argsort(size)
    size, c, found = size[by], {k: v[by] for k, v in c.items()}, Nearest(most)
    at = np.arange(len(by))
    first = np.searchsorted(size, (size & ~_MOST) | -(-PERCENT * (size & _MOST) // 100))
    before = at - first
    ends = np.cumsum(before)
    x = 0
    while x < len(at):  # some rows with all rows before them that may match
        y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + _STEP, "right")))
        j, m = np.repeat(at[x:y], before[x:y]), np.cumsum(before[x:y])
        i, j, apart = _possible(c, np.arange(len(j)) - np.repeat(m - at[x:y], before[x:y]), j)
        i, j = by[i].astype(np.int32), by[j].astype(np.int32)
        found.add(np.minimum(i, j), np.maximum(i, j), apart)
        x = y
    later, counts, earlier = found.lists()
    return copies, order[later], counts, order[earlier]


_PAIR = ["doc_id", "line", "other_doc", "other_line"]
_OTHER = pa.struct([("other_doc", pa.int64()), ("other_line", pa.int64())])
_LISTS = "doc_id long, line long, others array<struct<other_doc: long, other_line: long>>, more boolean"


def _lists(c: dict[str, np.ndarray], later, counts, earlier, named: int | None, copies=(), large=(), kept=()) -> pa.RecordBatch:
    """Rows of ``_LISTS`` for the rows ``later`` of ``c``, with ``named`` others
    of each at most, for ``copies``, and with their cells for ``large`` and, as
    ``more``, for ``kept``."""
    more = np.zeros(len(counts), bool) if named is None else counts > named
    if more.any():
        within = np.arange(len(earlier)) - np.repeat(np.cumsum(counts) - counts, counts)
        earlier, counts = earlier[within < named], np.minimum(counts, named)
    none, is_kept = np.concatenate([copies, large, kept]).astype(int), len(copies) + len(large)
    own, no = np.concatenate([none, later]), len(none)
    others = pa.StructArray.from_arrays([pa.array(c["doc_id"][earlier]), pa.array(c["line"][earlier])], fields=list(_OTHER))
    offsets = np.r_[np.zeros(no, int), 0, np.cumsum(counts)]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), others, mask=pa.array(np.arange(len(own)) < no))
    at = np.arange(len(own))
    is_cell = (at >= len(copies)) & (at < no)
    cell = [pa.array(c[k][own], mask=~is_cell) for k in ("low", "high", "packed")]
    word = pa.array(c["word"][own], mask=at < len(copies))
    return pa.RecordBatch.from_arrays([pa.array(c["doc_id"][own]), pa.array(c["line"][own]), lists, pa.array(np.r_[at[:no] >= is_kept, more]), word, *cell],
                                      names=["doc_id", "line", "others", "more", "word", "low", "high", "packed"])


def _chunks(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``(part, cells)`` of rows of :func:`cells`: a part and a row of ``_CELL``
    for each cell."""
    column = batch.column("cells")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    rows = np.frombuffer(data, np.int64)[ends[0] // 8:ends[-1] // 8].reshape(-1, len(_CELL))
    return np.repeat(batch.column("part").to_numpy(), np.diff(ends) // (8 * len(_CELL))), rows


def _named(cell: DataFrame, named: int, group: int) -> DataFrame:
    """``doc_id, line, others`` of each word's lines with candidates, the nearest
    ``named`` first, and if there are ``more``; copies have null for ``others``.
    Rows of words with more than ``group`` come back as cells, and so do, marked
    ``more``, those of words with a line that has more. Rows of one word stay in
    one task and, but for words with many, in one block."""
    full = max(BLOCK // 2, 2 * group)

    def answer(rows, spilt):
        word = rows[:, 0].copy()
        order = np.argsort(word)
        # Words of one line meet nothing.
        new = np.r_[True, word[order[1:]] != word[order[:-1]], True]
        use = order[~(new[1:] & new[:-1]) | (rows[order, -1] == _COPY) | np.isin(word[order], spilt)]
        if not len(use):
            return
        c = dict(zip(_CELL, rows[use].T.copy()))
        group_of = np.cumsum(np.r_[True, c["word"][1:] != c["word"][:-1]])
        doc = c["doc_id"] - c["doc_id"].min()
        bits = [int(x.max()).bit_length() if x.min() >= 0 else 64 for x in (group_of, doc, c["line"])]
        if sum(bits) < 64:
            order = np.argsort((group_of << (bits[1] + bits[2])) | (doc << bits[2]) | c["line"])
        else:
            order = np.lexsort((c["line"], c["doc_id"], group_of))
        c = {k: v[order] for k, v in c.items()}
        words, counts = np.unique(c["word"], return_counts=True)
        is_large = np.repeat((counts > group) | np.isin(words, spilt), counts)
        known = c["packed"] == _COPY
        few, many = np.flatnonzero(~is_large & ~known), np.flatnonzero(is_large & ~known)
        copies, later, counts, earlier = candidates({k: v[few] for k, v in c.items()}, named + 1)
        again, more = _copies({k: v[many] for k, v in c.items()})
        copies = np.concatenate([np.flatnonzero(known), few[copies], many[more]])
        asks = np.unique(c["word"][few[later[counts > named]]])
        kept = few[np.isin(c["word"][few], asks)] if len(asks) else ()
        yield _lists(c, few[later], counts, few[earlier], named, copies, many[~again], kept)

    def run(batches):
        held, size, most = [], 0, full
        spilt = np.empty(0, np.int64)  # words of the last part whose first rows came back already
        for batch in batches:
            held.append(_chunks(batch))
            size += len(held[-1][0])
            if size < most:
                continue
            part, rows = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(part, part[-1]))
            if cut:
                yield from answer(rows[:cut], spilt)
                part, rows, spilt = part[cut:], rows[cut:], spilt[:0]
            if len(rows) >= full:
                words, n = np.unique(rows[:, 0], return_counts=True)
                spilt = np.union1d(spilt, words[n > group])
                out = np.isin(rows[:, 0], spilt)
                yield from answer(rows[out], spilt)
                part, rows = part[~out], rows[~out]
            held, size = [(part, rows)], len(rows)
            most = max(full, 2 * size)
        if size:
            yield from answer(np.concatenate([x for _, x in held]), spilt)

    return (cell.repartition("part").sortWithinPartitions("part")
            .mapInArrow(lean(run), _LISTS + ", word long, low long, high long, packed long"))


def _tiled(rows: DataFrame, named: int | None, group: int) -> DataFrame:
    """``_LISTS`` and ``word`` of ``rows(cell columns, asks)``: the candidates of
    the lines that ask, the nearest ``named`` over a word's tiles, about, or
    all if it is None. Each pair of a word's rows meets in one task."""
    tiles = rows.groupBy("word").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("doc_id", "line"), F.col("tiles")).cast("int")
    dealt = (rows.join(tiles, "word").withColumn("tile", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select(*_CELL, "asks", "tiles", "tile", F.least("tile", "with").alias("one"), F.greatest("tile", "with").alias("two")))
    names = [*_CELL, "asks", "tiles", "tile", "one", "two"]

    def run(batches):
        held: dict[str, list[np.ndarray]] = {k: [] for k in names}

        def answer(c):
            most = None if named is None else max(1, named // int(c["tiles"][0]))
            inside, found = c["one"][0] == c["two"][0], Nearest(None if most is None else most + 1)
            size, asks = len(c["word"]), np.flatnonzero(c["asks"])
            step = max(1, _PAIRS // size)
            for at in range(0, len(asks), step):
                later = asks[at:at + step]
                j, i = np.repeat(later, later), np.concatenate([np.arange(x) for x in later]) if len(later) else later
                if not inside:
                    ok = c["tile"][i] != c["tile"][j]
                    i, j = i[ok], j[ok]
                other = (c["doc_id"][i] != c["doc_id"][j]) | (c["line"][i] != c["line"][j])
                found.add(*_possible(c, i[other], j[other]))
                if most is None:
                    yield _lists(c, *found.lists(), most)
                    found = Nearest(None)
            if most is not None:
                yield _lists(c, *found.lists(), most)

        for batch in batches:
            new = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            key = [new[k] for k in ("word", "one", "two")]
            starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)])
            for x, y in zip(starts, np.r_[starts[1:], len(key[0])]):
                if held["word"] and any(held[k][-1][-1] != new[k][x] for k in ("word", "one", "two")):
                    yield from answer({k: np.concatenate(v) for k, v in held.items()})
                    held = {k: [] for k in names}
                for k in names:
                    held[k].append(new[k][x:y])
        if held["word"]:
            yield from answer({k: np.concatenate(v) for k, v in held.items()})

    return (dealt.repartition("word", "one", "two").sortWithinPartitions("word", "one", "two", "doc_id", "line")
            .mapInArrow(lean(run), _LISTS + ", word long, low long, high long, packed long").select("doc_id", "line", "others", "more", "word"))


def _asked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, text`` (packed) of the documents in ``pairs``, and of the few
    others that share a bit with one of them: the table of bits has a bounded
    size, and a join by ``doc_id`` leaves the others out."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(ASKED))
    bits = pairs.select(F.explode(F.array(bit("doc_id"), bit("other_doc"))).alias("bit")).distinct()
    rows = (bits.groupBy(F.floor(F.col("bit") / _PART).alias("part"))
            .agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(_PART))).alias("bits")).collect())  # at most ``ASKED`` bits
    table = np.zeros((-(-ASKED // _PART), _PART // 8), np.uint8)
    for r in rows:
        table[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    table = docs.sparkSession.sparkContext.broadcast(table.ravel())

    def keep(b):
        at = b.column("bit").to_numpy(zero_copy_only=False)
        return (table.value[at >> 3] >> (at & 7) & 1).astype(bool)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    return packed(texts.withColumn("bit", bit("doc_id")), keep).select("doc_id", "text")


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, line`` of the later lines in ``pairs`` of which one pair is a
    match. The words of both lines go to where the earlier line is. ``pairs``
    are read twice. The join of the texts is the same at every size."""
    texts = _asked(docs, pairs)
    pairs = pairs.select(*_PAIR).distinct()
    at = F.struct(F.col("other_doc").alias("doc_id"), F.col("other_line").alias("line")).alias("at")
    sent = (pairs.select("doc_id", "line", at, F.lit(False).alias("is_other"))
            .unionByName(pairs.select(F.col("other_doc").alias("doc_id"), F.col("other_line").alias("line"), at, F.lit(True).alias("is_other")).distinct()))
    lists = sent.groupBy("doc_id").agg(F.collect_list(F.struct("line", "at", "is_other")).alias("asked"))  # of one document's lines
    names = ["at_doc", "at_line", "is_other", "doc_id", "line", "words"]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())

    def fetch(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        z, short = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for b in batches:
            rows = []
            for doc, text, asked in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("asked").to_pylist()):
                lines, sets = z.decompress(text.as_py()).lower().split(b"\n"), {}
                for r in asked:
                    if r["line"] not in sets:
                        sets[r["line"]] = short.compress(b" ".join(dict.fromkeys(lines[r["line"]].split())))
                    rows.append((r["at"]["doc_id"], r["at"]["line"], r["is_other"], doc, r["line"], sets[r["line"]]))
                    if len(rows) == 5000:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

    def verify(batches):
        z, other, words = zstandard.ZstdDecompressor(), None, None
        for b in batches:
            out = []
            for d, n, first, doc, line, text in zip(*(b.column(c).to_pylist() for c in names)):
                if first:
                    other, words = (d, n), set(z.decompress(text).split())
                elif (d, n) == other:
                    own = set(z.decompress(text).split())
                    both = len(words & own)
                    if 100 * both >= PERCENT * (len(words) + len(own) - both):
                        out.append((doc, line))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["doc_id", "line"])

    fetched = texts.join(lists.hint("merge"), "doc_id").select("doc_id", "text", "asked").mapInArrow(lean(fetch), "at_doc long, at_line long, is_other boolean, doc_id long, line long, words binary")
    return (fetched.repartition("at_doc", "at_line").sortWithinPartitions("at_doc", "at_line", F.desc("is_other"))
            .mapInArrow(lean(verify), "doc_id long, line long").distinct())


def removed(docs: DataFrame, min_words: int = EVERY, named: int = NAMED, group: int = GROUP) -> DataFrame:
    """``doc_id, line`` (from 0) of the lines that go; ``doc_id`` as long."""
    ranks = docs.sparkSession.sparkContext.broadcast(rarity(docs))
    found = stored(_named(cells(docs, ranks, min_words), named, group), "named")
    copies = found.where("others is null and packed is null").select("doc_id", "line")
    lists = found.where("others is not null").select("doc_id", "line", "others", "more", "word")
    large = found.where("packed is not null and not more").select(*_CELL, F.lit(True).alias("asks"))
    if not large.isEmpty():
        lists = lists.unionByName(stored(_tiled(large, named, group), "tiled"))
    pairs = lambda rows, others: rows.select("doc_id", "line", F.inline(others))
    matched = stored(_verified(docs, pairs(lists, F.slice("others", 1, NEAREST))), "matched")
    lines = stored(lists.where(F.size("others") > NEAREST).select("doc_id", "line").distinct()
                   .join(matched, ["doc_id", "line"], "left_anti").join(copies, ["doc_id", "line"], "left_anti"), "lines")
    if not lines.isEmpty():
        rest = stored(lists.where(F.size("others") > NEAREST).join(lines, ["doc_id", "line"], "left_semi"), "rest")
        matched = matched.unionByName(stored(_verified(docs, pairs(rest, F.slice("others", NEAREST + 1, named))), "matched"))
    left = stored(lists.where("more").select("word", "doc_id", "line").distinct()
                  .join(matched, ["doc_id", "line"], "left_anti").join(copies, ["doc_id", "line"], "left_anti"), "left")
    if not left.isEmpty():
        again = found.where("packed is not null").select(*_CELL).join(left.select("word").distinct(), "word", "left_semi")
        asks = left.select("word", "doc_id", "line", F.lit(True).alias("asks"))
        again = stored(again.join(asks, ["word", "doc_id", "line"], "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "again")
        every = stored(_tiled(again, None, group), "tiled")
        matched = matched.unionByName(stored(_verified(docs, pairs(every, "others")), "matched"))
    return copies.unionByName(matched).distinct()


def digest(docs: DataFrame, min_words: int = EVERY, named: int = NAMED, group: int = GROUP) -> DataFrame:
    """``doc_id, n_removed, removed`` (line numbers, ascending, joined by
    commas) of each distinct doc_id; a null one has none."""
    lists = (removed(docs, min_words, named, group).groupBy("doc_id")
             .agg(F.sort_array(F.collect_list("line")).alias("lines")).withColumnRenamed("doc_id", "_id"))
    ids = docs.select("doc_id").distinct().withColumn("_id", F.col("doc_id").cast("long"))
    lines = F.coalesce("lines", F.array().cast("array<int>"))
    return ids.join(lists, "_id", "left").select(
        "doc_id", F.size(lines).cast("long").alias("n_removed"), F.array_join(lines.cast("array<string>"), ",").alias("removed"))


def dedup_lines(docs: DataFrame, min_words: int = EVERY, named: int = NAMED) -> DataFrame:
    """``docs`` with the matched lines cut out of ``text``; a document whose
    lines all go keeps an empty text. All other columns stay, whatever their names."""
    key, gone = free_name(docs), free_name(docs)
    lists = (removed(docs, min_words, named).groupBy("doc_id").agg(F.collect_set("line").alias(gone))
             .withColumnRenamed("doc_id", key))

    def keep(text: bytes, lines: list[int] | None) -> bytes:
        cut = set(lines or ())
        return b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in cut) if cut else text

    joined = packed(docs).withColumn(key, F.col("doc_id").cast("long")).join(lists.hint("merge"), key, "left")
    return unpacked(joined.select(*docs.columns, gone), docs.schema, keep, gone)
