"""Spelling variants: words of a corpus that differ by one code point.

Two words are near if one inserted, deleted or replaced code point makes them
equal. Such words agree in the first or in the last half of the shorter one, so
a word meets its near words in a block that is named by one of its halves and
holds what is left of its words. A block is a sorted list; each word scans the
words behind it with a band of three cells of the edit matrix a row. A word
resumes at the row of the prefix it shares with the word before it (the LCP),
and a range of words whose shared prefix has used its one edit is left at once,
for the next prefix that can still match. A pair counts in one block only, the
first half's if they agree in it. A block of more than ``BLOCK`` words is not
held: its rows are cut in halves once more and meet in smaller blocks, until
what is left is a code point or two.

Null and empty texts hold no words. A null ``doc_id`` is named by the empty
string. Repeated rows count as often as they occur. Words tie by code points.
Only ``doc_id`` and the text are read, so that other columns may have any name.
Texts of any length are read whole, in slices that end between two runs.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Runs of letters; of one run in ``DAMAGE`` a code point is deleted.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DAMAGE = 97
MIN_LENGTH = 5
MIN_COUNT = 3
#: A word's form occurs this many times as often, at least.
RATIO = 2
#: Words that a task holds of one block; a larger block is cut.
BLOCK = 100_000
#: Distinct words counted in a task before they are handed on, characters read at once, rows of a batch.
_COUNTED = 200_000
_SLICE = 1 << 20
_ROWS = 20_000

_LOWER = {i: i + 32 for i in range(65, 91)}
_LAST = "\U0010ffff"
_NOT_LETTER = re.compile("[^A-Za-zÀ-ÿ]")

_BLOCKS = "key string, rest string, word string, n long"
_FOUND = "word string, n long, n_near long, form_n long, form string, key string, rest string"


def _slices(text: str):
    at = 0
    while len(text) - at > _SLICE:
        cut = _NOT_LETTER.search(text, at + _SLICE)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def observed(doc_id, text: str, damage: int = DAMAGE) -> Counter:
    """Words of a text as they are counted, with their number."""
    runs: Counter = Counter()
    for part in _slices(text):
        runs.update(RUN.findall(part))
    out: Counter = Counter()
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        word = run.lower() if run.isascii() else run.translate(_LOWER)
        h = zlib.crc32(word.encode(), head)
        if h % damage == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        out[word] += n
    return out


def vocabulary(docs: DataFrame, text_col: str = "text", damage: int = DAMAGE,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of all words of at least ``min_length`` code points with at
    least ``min_count`` occurrences in ``docs``."""

    def rows(total: Counter):
        held = [(w, n) for w, n in total.items() if len(w) >= min_length]
        for at in range(0, len(held), _ROWS):
            words, counts = zip(*held[at:at + _ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    def count(batches):
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                if text.is_valid:
                    total.update(observed(doc_id, text.as_py(), damage))
                if len(total) > _COUNTED:
                    yield from rows(total)
                    total.clear()
        yield from rows(total)

    return (docs.select(F.col("doc_id").cast("string"), text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def halves(rest: str):
    """``(name, what is left)`` of the blocks a word meets near words in."""
    for k in {len(rest) // 2, (len(rest) - 1) // 2}:
        if k > 0:
            yield f"<{k} {rest[:k]}", rest[k:]
            yield f">{k} {rest[-k:]}", rest[:-k]


def _cuts(key: str) -> list[tuple[str, int]]:
    return [(part[0], int(part[1:].partition(" ")[0])) for part in key.split("|")]


def _first_block(cuts: list[tuple[str, int]], a: str, b: str) -> bool:
    """Whether a block of these cuts is the one in which the pair counts."""
    for side, n in cuts:
        k = min(len(a), len(b)) // 2
        if k != n or (a[:k] == b[:k]) != (side == "<"):
            return False
        a, b = (a[k:], b[k:]) if side == "<" else (a[:-k], b[:-k])
    return True


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def near_pairs(words: list[str]):
    """Places ``i < j`` of the words of a sorted list without repeats that are
    one edit apart. ``rows[d]`` holds the distances of the first ``d``
    characters of the scanned word to the first ``d - 1, d, d + 1`` of word
    ``i``, with 2 for anything larger."""
    shared = [_shared(a, b) for a, b in zip(words, words[1:])]
    rows = [(1, 0, 1)] * (max(map(len, words), default=0) + 2)
    for i, q in enumerate(words):
        size = len(q)
        ends = q + "\0\0"  # in no word
        known, touched = size, 0  # the rows of q's own prefixes hold no edit
        j = i + 1
        while j < len(words):
            w = words[j]
            d = min(shared[j - 1], known)
            x, y, z = rows[d]
            while d < len(w):
                c = w[d]
                left = 2 if d == 0 else x if ends[d - 1] == c else x + 1
                if y + 1 < left:
                    left = y + 1
                mid = 2 if d >= size else y if ends[d] == c else y + 1
                if left + 1 < mid:
                    mid = left + 1
                if z + 1 < mid:
                    mid = z + 1
                right = 2 if d + 1 >= size else z if ends[d + 1] == c else z + 1
                if mid + 1 < right:
                    right = mid + 1
                if left > 1 and mid > 1 and right > 1:
                    break
                x, y, z = left, mid, right
                d += 1
                rows[d] = (x, y, z)
                if d > touched:
                    touched = d
            else:
                if abs(len(w) - size) < 2 and (x, y, z)[size - len(w) + 1] < 2:
                    yield i, j
                known = d
                j += 1
                continue
            # All words that share w's first d + 1 characters are out. Next: a
            # character that the row's edits still let follow, or another prefix.
            c, at = w[d], _LAST
            if x < 2 and d and c < ends[d - 1] < at:
                at = ends[d - 1]
            if y < 2 and c < ends[d] < at:
                at = ends[d]
            if z < 2 and d + 1 < size and c < ends[d + 1] < at:
                at = ends[d + 1]
            j = bisect_left(words, w[:d] + at, j + 1)
            if j < len(words):
                known = _shared(w[:d], words[j])
        for d in range(touched + 1):
            rows[d] = (1, 0, 1)


def _better(a: tuple[int, str] | None, n: int, word: str) -> tuple[int, str]:
    return (n, word) if a is None or (-n, word) < (-a[0], a[1]) else a


def _blocks(batches):
    for b in batches:
        out = [(k, r, w, n) for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()) for k, r in halves(w)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["key", "rest", "word", "n"])


def _found(block: int):
    """Near words of each word of a block, combined; the rows of a block that
    is too large, under the names of the halves of what is left."""
    names = ["word", "n", "n_near", "form_n", "form", "key", "rest"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    def rows(batches):
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("key", "rest", "word", "n")))

    def deeper(key, rest, word, n):
        return [(word, n, None, None, None, f"{key}|{k}", r) for k, r in halves(rest)]

    def scan(key, held, large):
        cuts, best, count = _cuts(key), {}, Counter()
        for i, j in near_pairs([r for r, _, _ in held]):
            (r, a, n), (s, b, m) = held[i], held[j]
            if _first_block(cuts, a, b) and not (large and min(len(r), len(s)) > 1):
                count[i] += 1
                count[j] += 1
                best[i] = _better(best.get(i), m, b)
                best[j] = _better(best.get(j), n, a)
        return [(held[i][1], held[i][2], c, *best[i], None, None) for i, c in count.items()]

    def run(batches):
        out: list = []
        for key, group in groupby(rows(batches), key=lambda r: r[0]):
            held, large = [], False
            for _, rest, word, n in group:
                if large:
                    out += deeper(key, rest, word, n)
                if not large or len(rest) < 3:
                    held.append((rest, word, n))
                if len(held) > block and not large:
                    large = True
                    out += [x for r, w, m in held for x in deeper(key, r, w, m)]
                    held = [h for h in held if len(h[0]) < 3]  # pairs that no cut can part
                if len(out) > _ROWS:
                    yield batch(out)
                    out = []
            if len(held) > 1:
                out += scan(key, held, large)
            if len(out) > _ROWS:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return run


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, form_n, form`` of all rows of ``words(word, n)``: the
    number of words one edit away, and of these the most frequent one with its
    count (ties: the first by code points); 0 and nulls where there is none."""
    rows = words.mapInArrow(_blocks, _BLOCKS)
    parts = []
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key", "rest", "word")
        found = stored(dealt.mapInArrow(_found(block), _FOUND), "near-words")
        parts.append(found.where("key is null").select("word", "n", "n_near", "form_n", "form"))
        rows = found.where("key is not null").select("key", "rest", "word", "n")
        if rows.isEmpty():
            break
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"),
                         F.lit(None).cast("string").alias("form"))
    for p in parts:
        alone = alone.unionByName(p)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    return (alone.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
            .select("word", "n", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)``, whose forms lead to no cycle:
    every round doubles the steps that a row has followed, so that the rounds
    are the logarithm of the longest way."""
    ways = forms.select("word", F.col("form").alias("root"))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ways = stored(ways.join(further, "root", "left")
                      .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = ways.where("_moved")
        ways = ways.select("word", "root")
        if moved.isEmpty():
            return ways


def group_variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``words(word, n)``. A word's
    form is its most frequent near word, if that one is at least ``ratio``
    (over 1) times as frequent; its root is the last form of the way."""
    held = F.col("form_n") >= ratio * F.col("n")
    near = stored(near_words(words, block).select(
        "word", "n", "n_near", F.when(held, F.col("form")).alias("form"), F.when(held, F.col("form_n")).alias("form_n")), "variants")
    ways = roots(near.where("form is not null"))
    return (near.join(ways, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The variants of all words of ``docs``."""
    return group_variants(stored(vocabulary(docs, text_col), "words"), block=block)
