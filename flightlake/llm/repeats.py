"""Suffix-array dedup: removes every byte covered by a string of ``least``
bytes that also starts anywhere else.

Equal strings have equal anchors: the anchor of a string of ``least`` bytes is
its ``K``-byte piece of least hash, the leftmost of equal ones. Neighbouring
strings of one anchor form a span of text, on average one in 80 bytes, and
only spans whose anchor occurs twice can hold a repeat. So the suffixes that
are sorted are those at anchors, in a bucket for each anchor's hash:

1. Anchors that occur once are dropped after a count, combined before the
   shuffle; copies of a text are one text.
2. Spans with the same content and anchor are one class; two members make the
   whole span repeated, and the class goes on as one witness.
3. In buckets with several classes, the suffixes at the anchors are sorted with
   their common prefixes (an enhanced suffix array), a stack scan gives the
   tree of prefix intervals, and within each interval the texts to the left are
   scanned the same way: where they differ, the group of that common extension
   is maximal to the left, and it is reported with all its occurrences.
4. A bucket of more than ``BUCKET`` classes is cut: each span gives its first
   and its second half of starts, which go to buckets of what all strings of
   that half share, and meet their equals there. Halves end at single strings,
   so a text that a third of all documents share ends as one class.

Null texts are empty; texts under ``least`` bytes are never touched; texts of
any length are searched whole, across all documents and within each, never
across two. Repeated rows are copies of each other. ``doc_id`` may be null or
repeated. Positions are those of the input.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, keeps, lean, packed, stored, unpacked

LEAST = 200
#: Bytes of an anchor, at most half of ``least``.
K = 40
#: Classes sorted in one bucket, at most.
BUCKET = 4000
#: Starts hashed at once, and texts remembered by a task to skip their copies.
_CHUNK = 1 << 18
_SEEN = 50_000

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = []
keeps(_POWERS.clear)


def hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every ``k``-byte piece of ``data``."""
    if not _POWERS or len(_POWERS[0]) < len(data):
        _POWERS[:] = (_powers(_BASE, len(data) + _CHUNK), _powers(_INVERSE, len(data) + _CHUNK))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWERS[0][:len(data)], out=total[1:])
    h = (total[k:] - total[:-k]) * _POWERS[1][:len(data) - k + 1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes, least: int = LEAST):
    """``(hash, anchor, start, end)`` arrays of the spans of ``text``: the
    strings of ``least`` bytes that begin from ``start`` to ``end - least`` have
    their anchor at ``anchor``."""
    k = min(K, least // 2)
    w = least - k + 1
    low = np.uint64((1 << 24) - 1)
    out = []
    for at in range(0, max(0, len(text) - least + 1), _CHUNK):
        h = hashes(np.frombuffer(text, np.uint8, min(len(text) - at, _CHUNK + least - 1), at), k)
        ranked = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        padded = np.full(-(-len(h) // w) * w, ~np.uint64(0))
        padded[:len(h)] = ranked
        tiles = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(tiles, axis=1).ravel()
        back = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        first = (np.minimum(back[:len(h) - w + 1], ahead[w - 1:len(h)]) & low).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(first[1:] != first[:-1]) + 1])
        ends = np.concatenate([starts[1:] - 1, [len(first) - 1]]) + least
        out.append((h[first[starts]].view(np.int64), first[starts] + at, starts + at, ends + at))
    return tuple(map(np.concatenate, zip(*out))) if out else (np.empty(0, np.int64),) * 4


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(lcp: list[int], least: int):
    """Prefix intervals ``(value, first, last)`` of an enhanced suffix array
    with values of ``least`` or more, inner ones first. ``lcp[i]`` is between
    suffixes i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            deep, first = stack.pop()
            if deep >= least:
                yield deep, first, i
        if not stack or stack[-1][0] < value:
            stack.append((value, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int, shortest: int):
    """Groups ``(left, right, members)`` of texts that agree on ``left`` bytes
    before and ``right`` bytes from their anchors, together ``least`` or more,
    and on no more on either side. ``lefts`` read backwards from the anchor;
    ``shortest`` is the least common right part."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    for right, first, last in intervals(lcp, shortest):
        inner = sorted(order[first:last + 1], key=lefts.__getitem__)
        # Left extensions: an interval of their common prefixes ends where they differ.
        left_lcp = [common(lefts[a], lefts[b]) for a, b in zip(inner, inner[1:])]
        for left, i, j in intervals(left_lcp, max(0, least - right)):
            members = inner[i:j + 1]
            nexts = {rights[m][right:right + 1] for m in members}
            if len(nexts) > 1 or nexts == {b""}:  # else the group of the deeper interval holds them
                yield left, right, members


def _spans_of(texts: DataFrame, least: int, hashes_only: bool) -> DataFrame:
    """Spans of the distinct ``texts(sig, text)``: ``h, f, sig, at, before,
    after``, one row for each anchor hash and content in a text, with the list
    of its anchors and the bytes before and after them; a text that repeats one
    word over and over gives a row, not one for each repetition. ``f`` is the
    hash of the content around its anchor. Or ``h, n`` alone: the hashes of a
    text, and 2 for those it holds more than once, else 1."""
    names = ["h", "n"] if hashes_only else ["h", "f", "sig", "before", "after", "at"]

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            parts = []
            for sig, text in zip(b.column("sig").to_pylist(), b.column("text")):
                if sig in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(sig)
                data = text.as_buffer().to_pybytes()
                h, at, lo, hi = anchors(data, least)
                if hashes_only:
                    h, n = np.unique(h, return_counts=True)
                    parts.append((h, np.minimum(n, 2)))
                elif len(h):
                    f = np.array([xxhash.xxh3_64_intdigest(data[x:y], z - x) for x, y, z in zip(lo.tolist(), hi.tolist(), at.tolist())],
                                 np.uint64).view(np.int64)
                    order = np.lexsort((at, f, h))
                    first = np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (f[order][1:] != f[order][:-1])])
                    one = order[first]
                    parts.append((h[one], f[one], np.full(len(one), sig), (at - lo)[one], (hi - at)[one],
                                  np.diff(np.r_[first, len(order)]), at[order]))
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts)]
                arrays = [pa.array(x, pa.int64()) for x in columns[:len(names) - (not hashes_only)]]
                if not hashes_only:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(columns[5])], pa.int32()), pa.array(columns[6])))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts.select("sig", "text").mapInArrow(lean(run), ", ".join(f"{n} {'array<long>' if n == 'at' else 'long'}" for n in names))


def _with_content(texts: DataFrame, spans: DataFrame, least: int) -> DataFrame:
    """``spans(key, sig, anchor, lo, hi, seen)`` with their ``content``. A list
    holds the spans of one text; copies of a text that meet in a task are one."""
    far = least - min(K, least // 2)
    lists = spans.groupBy("sig").agg(F.collect_list(F.struct("key", "anchor", "lo", "hi", "seen")).alias("spans"))

    def run(batches):
        done: set[int] = set()
        for b in batches:
            rows = []
            for sig, text, spans in zip(b.column("sig").to_pylist(), b.column("text"), b.column("spans")):
                if sig not in done:
                    done.add(sig)
                    data = text.as_buffer().to_pybytes()
                    rows += [{**s, "sig": sig, "content": data[s["lo"]:s["hi"]], "near": 0, "far": far} for s in spans.as_py()]
            yield pa.RecordBatch.from_pylist(rows, schema=_ITEM)

    return texts.join(lists, "sig").select("sig", "text", "spans").mapInArrow(lean(run), _ITEM_SQL)


#: near, far: the least and the most bytes from a start to its anchor that the item's bucket is for.
_ITEM_SQL = "key long, sig long, anchor long, lo long, hi long, seen boolean, content binary, near long, far long"
_ITEM = pa.schema([(n, t) for n, t in (("key", pa.int64()), ("sig", pa.int64()), ("anchor", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
                                       ("seen", pa.bool_()), ("content", pa.binary()), ("near", pa.int64()), ("far", pa.int64()))])


#: What names an item.
_PLACE = ["key", "sig", "anchor", "lo", "hi"]


def _groups(items: DataFrame, least: int, shortest: int, as_spans: bool) -> DataFrame:
    """Scans the buckets of ``items``: ``sig, lo, hi`` of repeated parts, as far
    as each member is not repeated as a whole, or, with ``as_spans`` false,
    ``repeat, length, start`` and the item of every occurrence in every group."""
    def run(batches):
        def read():
            for b in batches:
                yield from zip(*(b.column(n).to_pylist() for n in _ITEM.names))

        for _, bucket in groupby(read(), key=lambda r: r[0]):
            held = list({(r[1], r[2], r[3]): r for r in bucket}.values())
            if len(held) < 2:
                continue
            lefts = [r[6][:r[2] - r[3]][::-1] for r in held]
            rights = [r[6][r[2] - r[3]:] for r in held]
            reach: dict[int, tuple[int, int]] = {}
            rows = []
            for left, right, members in maximal_repeats(lefts, rights, least, shortest):
                if not as_spans:
                    name = xxhash.xxh3_64_intdigest(lefts[members[0]][:left] + b"|" + rights[members[0]][:right]) >> 1
                    rows += [(name, left + right, held[m][2] - left, *held[m][:5]) for m in members]
                    continue
                for m in members:
                    a, b = reach.get(m, (0, 0))
                    reach[m] = max(a, left), max(b, right)
            if as_spans:
                rows = [(held[m][1], held[m][2] - a, held[m][2] + b) for m, (a, b) in reach.items() if not held[m][5]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=names)

    names = ["sig", "lo", "hi"] if as_spans else ["repeat", "length", "start", *_PLACE]
    return (items.repartition("key").sortWithinPartitions("key").select(*_ITEM.names)
            .mapInArrow(lean(run), ", ".join(f"{n} long" for n in names)))


def _halves(items: DataFrame, least: int, parents: bool = False) -> DataFrame:
    """Both halves of each item: its strings that start near to the anchor and
    those that start far from it. The bucket of a half is the bytes that all
    their strings share; ``f`` is the hash of the content. With ``parents``,
    ``of_key, of_lo, of_hi`` of the item."""
    more = ["f", *(["of_key", "of_lo", "of_hi"] if parents else [])]

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                at, mid = r["anchor"], (r["near"] + r["far"]) // 2
                for near, far in ((r["near"], mid), (mid + 1, r["far"])):
                    lo, hi = max(r["lo"], at - far), min(r["hi"], at - near + least)
                    if near > far or hi - lo < least:
                        continue
                    content = r["content"][lo - r["lo"]:hi - r["lo"]]
                    shared = r["content"][at - near - r["lo"]:at - far + least - r["lo"]]
                    key = xxhash.xxh3_64_intdigest(shared, near * least + far) - (1 << 63)
                    f = xxhash.xxh3_64_intdigest(content, at - lo) - (1 << 63)
                    rows.append({**r, "key": key, "lo": lo, "hi": hi, "content": content, "near": near, "far": far, "f": f,
                                 "of_key": r["key"], "of_lo": r["lo"], "of_hi": r["hi"]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([*_ITEM, *(pa.field(n, pa.int64()) for n in more)]))

    return items.select(*_ITEM.names).mapInArrow(lean(run), _ITEM_SQL + "".join(f", {n} long" for n in more))


def _classes(spans: DataFrame) -> DataFrame:
    """One row for each key and content: its number of members and one of them."""
    return spans.groupBy("key", "f").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("seen", "sig", "anchor", "lo", "hi")).alias("one"))


def _several(rows: DataFrame) -> DataFrame:
    """Keys with two classes or more, and how many."""
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")


def _stands(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``members(key, f, to_sig, to_anchor)`` beside the item that goes on for
    their class: ``classes(key, f, sig, anchor, lo, hi)``."""
    return stored(members.join(classes.select("key", "f", *_PLACE[1:]), ["key", "f"]).select(*_PLACE, "to_sig", "to_anchor"), "stands")


def _everywhere(found: DataFrame, stands: DataFrame) -> DataFrame:
    """``repeat, length, sig, start`` of ``found(repeat, length, start, item)``
    in every member that the items stand for, at the same distance from the anchor."""
    return found.join(stands, _PLACE).select("repeat", "length", F.col("to_sig").alias("sig"), (F.col("start") - F.col("anchor") + F.col("to_anchor")).alias("start"))


def search(texts: DataFrame, least: int = LEAST, bucket: int = BUCKET, as_spans: bool = True) -> DataFrame:
    """Repeats in the distinct texts of ``texts(sig, text)``: ``sig, lo, hi`` of
    repeated parts, or all occurrences of the maximal groups."""
    shortest = min(K, least // 2)
    twice = _spans_of(texts, least, True).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    live = stored(_spans_of(texts, least, False).join(twice, "h", "left_semi"), "spans")
    lists = live.distinct().withColumnRenamed("h", "key")
    first = F.element_at("at", 1)
    classes = stored(lists.groupBy("key", "f").agg(F.sum(F.size("at")).alias("n"), F.max(F.struct(
        "sig", first.alias("anchor"), (first - F.col("before")).alias("lo"), (first + F.col("after")).alias("hi"))).alias("one")), "classes")
    whole = (lists.join(classes.where("n > 1").select("key", "f"), ["key", "f"], "left_semi")
             .select("key", "f", "sig", "before", "after", F.explode("at").alias("anchor"))
             .select("key", "f", "sig", (F.col("anchor") - F.col("before")).alias("lo"), (F.col("anchor") + F.col("after")).alias("hi")))
    out = [whole.select("sig", "lo", "hi") if as_spans else whole.select(
        F.xxhash64("key", "f").alias("repeat"), (F.col("hi") - F.col("lo")).alias("length"), "sig", F.col("lo").alias("start"))]
    wanted = classes.join(_several(classes).select("key"), "key", "left_semi").select(
        "key", "one.sig", "one.anchor", "one.lo", "one.hi", (F.col("n") > 1).alias("seen"))
    items = stored(_with_content(texts, wanted, least), "items")
    if not as_spans:
        stands = _stands(lists.select("key", "f", F.col("sig").alias("to_sig"), F.explode("at").alias("to_anchor")), classes.select("key", "f", "one.*"))
    while True:
        sizes = _several(items)
        found = stored(_groups(items.join(sizes.where(F.col("classes") <= bucket), "key", "left_semi"), least, shortest, as_spans), "found")
        out.append(found if as_spans else _everywhere(found, stands))
        large = sizes.where(F.col("classes") > bucket).select("key")
        if large.isEmpty():
            break
        halves = stored(_halves(items.join(large, "key", "left_semi"), least, not as_spans), "halves")
        classes = stored(_classes(halves), "classes")
        known = classes.where("n > 1").select("key", "f")
        met = halves.join(known, ["key", "f"], "left_semi")
        if as_spans:
            out.append(met.where("not seen").select("sig", "lo", "hi"))
        else:
            old = stands.withColumnsRenamed({"key": "of_key", "lo": "of_lo", "hi": "of_hi"})
            members = stored(halves.join(old, ["of_key", "sig", "anchor", "of_lo", "of_hi"]).select(
                "key", "f", "to_sig", "to_anchor", (F.col("to_anchor") - F.col("anchor") + F.col("lo")).alias("start"), (F.col("hi") - F.col("lo")).alias("length")), "members")
            out.append(members.join(known, ["key", "f"], "left_semi").select(F.xxhash64("key", "f").alias("repeat"), "length", F.col("to_sig").alias("sig"), "start"))
            stands = _stands(members.select("key", "f", "to_sig", "to_anchor"), classes.select("key", "f", "one.*"))
        ones = classes.join(_several(classes).select("key"), "key", "left_semi").select(
            "key", "f", "one.sig", "one.anchor", "one.lo", "one.hi", (F.col("n") > 1).alias("known"))
        items = stored(halves.join(ones, ["key", "f", "sig", "anchor", "lo", "hi"]).select(
            "key", "sig", "anchor", "lo", "hi", (F.col("seen") | F.col("known")).alias("seen"), "content", "near", "far"), "items")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _signed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_sig", F.xxhash64("_text"))


def covered(docs: DataFrame, least: int = LEAST, bucket: int = BUCKET) -> DataFrame:
    """``sig, spans`` of every text with repeated parts: a list of (lo, hi) in
    bytes, unordered, overlapping; ``sig`` is the text's hash."""
    own = _signed(docs.select("text")).select(F.col("_sig").alias("sig"), F.col("_text").alias("text")).where(F.octet_length("text") >= least)
    copies = own.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("hi")).where("n > 1")
    found = search(own, least, bucket).unionByName(
        copies.select("sig", F.lit(0).cast("long").alias("lo"), F.col("hi").cast("long").alias("hi")))
    # Of equal starts the longest is enough: combined before the shuffle, one row a place of the text at most.
    return (found.groupBy("sig", "lo").agg(F.max("hi").alias("hi"))
            .groupBy("sig").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))


def repeat_groups(docs: DataFrame, least: int = LEAST, bucket: int = BUCKET) -> DataFrame:
    """Maximal repeats inside the spans of one anchor, with all occurrences in
    the distinct texts: ``repeat`` (group), ``length``, ``sig``, ``start``."""
    own = _signed(docs.select("text")).select(F.col("_sig").alias("sig"), F.col("_text").alias("text")).where(F.octet_length("text") >= least)
    return search(own, least, bucket, False).distinct()


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by ``spans``, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def _with_spans(docs: DataFrame, least: int, bucket: int) -> DataFrame:
    """``docs`` with ``_text`` and ``_spans``."""
    spans = covered(docs, least, bucket).withColumnRenamed("sig", "_sig").withColumnRenamed("spans", "_spans")
    return _signed(docs).join(spans, "_sig", "left")


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    if not runs:
        return text
    ends = [0, *(hi for _, hi in runs)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(lo for lo, _ in runs), len(text)]))


def digest(docs: DataFrame, least: int = LEAST, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row."""
    def run(batches):
        for b in batches:
            rows = ([], [], [], [])
            for text, spans in zip(b.column("_text"), b.column("_spans")):
                data = text.as_buffer().to_pybytes()
                runs = merged(spans.as_py())
                kept = kept_bytes(data, runs)
                for to, x in zip(rows, (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())):
                    to.append(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(r, k) for r, k in zip(
                rows, (pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return _with_spans(docs.select("doc_id", "text"), least, bucket).select("doc_id", "_text", "_spans").mapInArrow(lean(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, least: int = LEAST, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; a cut inside a
    character drops what is left of it. Null texts stay null."""
    sig, runs = free_name(docs), free_name(docs)
    spans = covered(docs, least, bucket).select(F.col("sig").alias(sig), F.col("spans").alias(runs))
    signed = docs.withColumn(sig, F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = packed(signed).join(spans, sig, "left").select(*docs.columns, runs)
    return unpacked(joined, docs.schema, lambda text, spans: kept_bytes(text, merged(spans)), runs)
