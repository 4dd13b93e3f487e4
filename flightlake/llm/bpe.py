"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary gives the id of a
pre-token that is a token as a whole. Tier two, for the misses: the bytes of
the pre-token form a linked list, and a heap of adjacent pairs by rank merges
them, leftmost first among equal ranks. Both run inside map tasks on whole
texts; results of distinct chunks are kept in a bounded memo.

Null texts count as empty: no ids. Texts of any length are encoded whole;
repeated rows give equal results.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import heapq
import re
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import Memo

#: Pre-tokens and chunks remembered by a Python worker, at least; twice as many at most.
MEMO_SIZE = 400_000

#: Unicode white space, as pattern classes read ``\s``.
_S = "\t-\r \x85\xa0  -     　"
#: Cuts a text where no pre-token crosses: a space belongs to the run after it.
_CHUNK = re.compile(f" ?[^{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class PerfectHash:
    """Minimal perfect hash of byte keys by displacement: keys fall into
    buckets, and each bucket, the fullest first, takes the first seed that
    sends its keys to free slots. ``get`` verifies the key it finds."""

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        self.n = len(keys)
        self.buckets = max(1, -(-self.n // per_bucket))
        self.seed = [0] * self.buckets
        self.keys: list[bytes] = [b""] * self.n
        self.values: list[int] = [-1] * self.n
        held: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            held[h % self.buckets].append(i)
        free = bytearray(b"\1") * self.n
        singles = []
        for b in sorted(range(self.buckets), key=lambda b: -len(held[b])):
            if len(held[b]) < 2:
                singles += [(b, i) for i in held[b]]
                continue
            own, seed, slots = [hashes[i] for i in held[b]], 0, []
            while len(slots) < len(own):
                seed += 1
                slots = []
                for h in own:  # until one is taken
                    s = self._slot(h, seed)
                    if not free[s] or s in slots:
                        break
                    slots.append(s)
            self.seed[b] = seed
            for i, s in zip(held[b], slots):
                free[s] = 0
                self.keys[s], self.values[s] = keys[i], i
        for (b, i), s in zip(singles, (s for s in range(self.n) if free[s])):
            self.seed[b] = -s - 1  # a bucket of one key names its slot
            self.keys[s], self.values[s] = keys[i], i

    def _slot(self, h: int, seed: int) -> int:
        x = (h ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        return ((x * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> 32) % self.n

    def get(self, key: bytes) -> int:
        """The key's position in the list it was built from, or -1."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seed[h % self.buckets]
        s = -seed - 1 if seed < 0 else self._slot(h, seed)
        return self.values[s] if self.keys[s] == key else -1


def pairs_of(ranks: dict[bytes, int]) -> dict[int, int]:
    """Rank of the token that two tokens make, by ``left << 32 | right``."""
    return {left << 32 | right: r for token, r in ranks.items() for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None}


def merge(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """Ids of one pre-token from the ids of its bytes: the pair of lowest rank,
    leftmost first, is joined until no adjacent pair is in the vocabulary. The
    parts are linked; the heap holds ``rank << 32 | place``, and an entry whose
    place has another rank by now is passed over."""
    n, rank = len(ids), pairs.get
    wanted = [rank(a << 32 | b) for a, b in zip(ids, ids[1:])]
    wanted.append(None)
    heap = [r << 32 | i for i, r in enumerate(wanted) if r is not None]
    if not heap:
        return ids
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        top = heapq.heappop(heap)
        r, i = top >> 32, top & 0xFFFFFFFF
        if wanted[i] != r:
            continue
        gone = after[i]
        stop = after[i] = after[gone]
        ids[i], ids[gone], wanted[gone], wanted[i] = r, -1, None, None
        if stop < n:
            before[stop] = i
            w = wanted[i] = rank(r << 32 | ids[stop])
            if w is not None:
                heapq.heappush(heap, w << 32 | i)
        p = before[i]
        if p >= 0:
            w = wanted[p] = rank(ids[p] << 32 | r)
            if w is not None:
                heapq.heappush(heap, w << 32 | p)
    return [t for t in ids if t >= 0]


class Codec:
    """Encoder and decoder of one rank file and pre-token pattern."""

    def __init__(self, rank_path: str, pattern: str):
        lines = [x.split() for x in open(rank_path, "rb") if x.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.pattern = regex.compile(pattern)
        self.tokens = list(self.ranks)
        self.ids = list(self.ranks.values())
        self.whole = PerfectHash(self.tokens)
        self.bytes_of = dict(zip(self.ids, self.tokens))
        self.pairs = pairs_of(self.ranks)
        self.byte_ids = [self.ranks[bytes([b])] for b in range(256)]
        self.pieces = Memo(self._piece, MEMO_SIZE)
        self.memo = Memo(self._chunk, MEMO_SIZE)
        self.digests = Memo(self._digest, MEMO_SIZE)

    def _piece(self, piece: str) -> tuple[int, ...]:
        b = piece.encode()
        at = self.whole.get(b)
        return (self.ids[at],) if at >= 0 else tuple(merge([self.byte_ids[x] for x in b], self.pairs))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(chunk))))

    def _digest(self, chunk: str) -> tuple[int, bytes, bytes]:
        ids = self._chunk(chunk)
        return len(ids), b"".join(b"%d," % i for i in ids), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, _CHUNK.findall(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """Number of ids of a text, and the SHA-256 of these as decimals joined
        by commas and of the bytes they decode to. A chunk's decimals and
        decoded bytes are remembered together, a few thousand are joined at once."""
        n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        chunks = _CHUNK.findall(text)
        for at in range(0, len(chunks), 4096):
            counts, decimals, decoded = zip(*map(self.digests.__getitem__, chunks[at:at + 4096]))
            n += sum(counts)
            shown = b"".join(decimals)
            ids_hash.update(shown if at + 4096 < len(chunks) else shown[:-1])
            text_hash.update(b"".join(decoded))
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


@functools.cache
def codec(rank_path: str, pattern: str) -> Codec:
    """One codec for each Python worker; the files are read where the task runs."""
    made = Codec(rank_path, pattern)
    # Its tables stay, and remembered ids hold no cycles: collections need not look for them often.
    gc.freeze()
    gc.set_threshold(100_000, 20, 100)
    return made


def _texts(column) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text",
           out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text_col`` in ``out_col`` (array<int>), which
    replaces a column of that name."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    rest = [c for c in df.columns if c != out_col]
    schema = StructType([*df.select(*rest).schema.fields, StructField(out_col, ArrayType(IntegerType()))])

    def run(batches):
        c = codec(rank_path, pattern)
        for b in batches:
            ids = pa.array([c.encode(t) for t in _texts(b.column(text_col))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in rest], ids], names=[*rest, out_col])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of ``ids_col`` in ``out_col`` (binary); null ids
    decode to nothing, an id outside of the vocabulary raises ``KeyError``."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    rest = [c for c in df.columns if c != out_col]
    schema = StructType([*df.select(*rest).schema.fields, StructField(out_col, BinaryType())])

    def run(batches):
        c = codec(rank_path, pattern)
        for b in batches:
            got = pa.array([c.decode(x or []) for x in b.column(ids_col).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in rest], got], names=[*rest, out_col])

    return df.mapInArrow(run, schema)


def round_trip(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Digest of encoding and decoding each text: ``doc_id, n_tokens,
    ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256``,
    without writing the ids out."""
    def run(batches):
        c = codec(rank_path, pattern)
        for b in batches:
            got = [c.round_trip(t) for t in _texts(b.column("text"))]
            n, ids_hash, text_hash = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
