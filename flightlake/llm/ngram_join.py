"""N-gram Jaccard join by blocked sparse matrix products.

Rows of the incidence matrix are the distinct shingle sets of the documents,
columns are the shingles, in the order of their hashes. Two sets of Jaccard
0.8 or more share at least ``need`` of the first ``prefix_size`` columns of
either (a bound from the sizes alone), so only that leading part of each row is
shuffled to find candidates:

1. Columns of one row are dropped after a count, which is combined before the
   shuffle. Rows left with fewer than ``need`` columns have no links.
2. Every column names its fullest row as its hub, and the rows of all columns
   with one hub form a block. A row leaves a block in which it has under its
   share of ``need``; the pair's best block always keeps both.
3. Blocks get whole rows. A large block is dealt into parts, each with its hub.
   In a part, the product of a row with all rows of fitting size counts the
   overlaps; rows that are connected already are not multiplied again, and a
   link is reported only if it connects two components.
4. Rows of a dealt block that its hub's component does not hold then meet all
   rows of the block in tiles of two parts, each pair in one tile, so no pair of
   a block is left out and a task has two parts at most.

Exact copies are one row. Columns that a third of all rows share cost a counter
each per task in step 1, and a copy group of any size is one block whose rows
its hub connects in one product.

Texts that are null, empty or without words have an empty set and no links.
Documents with a null ``doc_id`` take part in nothing: their ``component_id``
is null. Repeated rows are copies of each other. Shingles and sets are known
by 64-bit hashes.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, packed, stored, unpacked
from .components import components

SHINGLE = 5
#: Jaccard threshold in percent.
PERCENT = 80
#: Part of a row, one in so many columns, that is searched beyond the least prefix.
EXTRA = 20
#: Columns in a part of a block, about; a part has one row at least.
PART_TOKENS = 1_000_000

_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
               0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes (int64) of the 5-word shingles of a text, A-Z as
    a-z; of the whole sequence if it has fewer words."""
    words = text.lower().split()  # on bytes: A-Z and the six ASCII white spaces only
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(SHINGLE, len(h))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        x += h[i:len(h) - k + 1 + i] * _P[i]
    x = (x ^ (x >> np.uint64(31))) * _P[3]
    return np.unique((x ^ (x >> np.uint64(29))).view(np.int64))


def prefix_size(n: int) -> int:
    return min(n, n - -(-PERCENT * n // 100) + 1 + n // EXTRA)


def need(n):
    """Columns that a row of ``n`` shares with any linked row, in the prefixes
    of both. Also for Column arguments."""
    if isinstance(n, int):
        return 1 + -(-PERCENT * n // 100) // EXTRA
    return F.floor(F.ceil(F.lit(PERCENT) * n / 100) / EXTRA) + 1


def rows(docs: DataFrame) -> DataFrame:
    """``doc_id, n, sig, prefix`` of each document; sig is null without words."""
    def run(batches):
        for b in batches:
            sizes, sigs, offsets, parts = [], [], [0], []
            for t in b.column("text"):
                s = shingles(t.as_buffer().to_pybytes()) if t.is_valid else shingles(b"")
                sizes.append(len(s))
                sigs.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                parts.append(s[:prefix_size(len(s))])
                offsets.append(offsets[-1] + len(parts[-1]))
            values = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                names=["doc_id", "n", "sig", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n long, sig long, prefix array<long>")


def whole_rows(texts: DataFrame) -> DataFrame:
    """``sig, cols`` of ``texts(sig, text)``, with packed texts."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            got = [shingles(z.decompress(t.as_py())) for t in b.column("text")]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]) if got else [0]
            values = pa.array(np.concatenate(got) if got else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("sig"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["sig", "cols"])

    return texts.select("sig", "text").mapInArrow(lean(run), "sig long, cols array<long>")


def links_of_part(keys: list[int], cols: list[np.ndarray], hub: int, known: list[int], second: list[bool]) -> list[tuple[int, int]]:
    """Links among the rows of one part that connect it as all its links would.
    ``known`` has a label of each row; rows of one label are connected already.
    Rows that are ``second`` meet only those that are not, if there are any."""
    order = sorted(range(len(keys)), key=lambda i: (second[i], len(cols[i])))
    keys, cols = [keys[i] for i in order], [cols[i] for i in order]
    label = np.array([known[i] for i in order])
    size = np.array([len(c) for c in cols])
    starts = np.concatenate([[0], np.cumsum(size)])
    names, at = np.unique(np.concatenate(cols), return_inverse=True)
    flag = np.zeros(len(names), bool)
    out = []

    def multiply(i: int, lo: int, hi: int) -> None:
        """Overlaps of row i with rows lo to hi - 1."""
        if not (label[lo:hi] != label[i]).any():
            return
        own = at[starts[i]:starts[i + 1]]
        flag[own] = True
        both = np.add.reduceat(flag[at[starts[lo]:starts[hi]]], starts[lo:hi] - starts[lo], dtype=np.int64)
        flag[own] = False
        for j in (np.flatnonzero(100 * both >= PERCENT * (size[i] + size[lo:hi] - both)) + lo).tolist():
            if label[j] != label[i]:
                out.append((keys[i], keys[j]))
                label[label == label[j]] = label[i]

    if any(second):
        cut = len(keys) - sum(second)
        lows = cut + np.searchsorted(size[cut:], -(-PERCENT * size[:cut] // 100))
        tops = cut + np.searchsorted(size[cut:], 100 * size[:cut] // PERCENT, "right")
        for i in range(cut):
            multiply(i, int(lows[i]), int(tops[i])) if tops[i] > lows[i] else None
        return out
    if hub in keys:
        multiply(keys.index(hub), 0, len(keys))
    tops = np.searchsorted(size, 100 * size // PERCENT, "right")  # rows of fitting size
    for i in range(len(keys)):
        multiply(i, i + 1, int(tops[i])) if tops[i] > i + 1 else None
    return out


def _links(parts: DataFrame) -> DataFrame:
    """``a, b`` from ``parts(hub, one, two, part, sig, label, cols)``: the rows
    of the parts ``one`` and ``two`` of a block meet, or those of one part."""
    def run(batches):
        def read():
            for b in batches:
                cols = b.column("cols")
                values, offsets = cols.values.to_numpy(zero_copy_only=False), cols.offsets.to_numpy()
                for i, x in enumerate(zip(*(b.column(c).to_pylist() for c in ("hub", "one", "two", "sig", "label", "part")))):
                    yield (*x, values[offsets[i]:offsets[i + 1]].copy())

        for (hub, one, _), group in groupby(read(), key=lambda x: x[:3]):
            held = {x[3]: x[4:] for x in group}
            second = [x[1] != one for x in held.values()]
            if len(held) > 1 and not all(second):
                found = links_of_part(list(held), [x[2] for x in held.values()], hub, [x[0] for x in held.values()], second)
                if found:
                    a, b = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (parts.select("hub", "one", "two", "part", "sig", "label", "cols").repartition("hub", "one", "two")
            .sortWithinPartitions("hub", "one", "two").mapInArrow(lean(run), "a long, b long"))


def tiles(rows: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """``rows(hub, sig, n, label, apart)`` of large blocks, dealt into parts, rows
    that are ``apart`` and others in different ones: a row for each tile
    ``one, two`` of two parts. An ``apart`` row meets each other row of its block
    in one tile; the others do not meet each other."""
    tokens = lambda which: F.ceil(F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)) / part_tokens).cast("int")
    parts = rows.groupBy("hub").agg(tokens(F.col("apart")).alias("p"), tokens(~F.col("apart")).alias("q")).where("p > 0")
    own = F.when(F.col("apart"), F.pmod(F.xxhash64("sig"), F.col("p"))).otherwise(F.col("p") + F.pmod(F.xxhash64("sig"), F.col("q")))
    return (rows.join(parts, "hub").withColumn("part", own.cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.when(F.col("apart"), F.col("p") + F.col("q") - 1).otherwise(F.col("p") - 1))))
            .select("hub", F.least("part", "with").alias("one"), F.greatest("part", "with").alias("two"), "part", "sig", "n", "label"))


def blocks(found: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """``hub, sig, n, parts`` of the blocks, from ``rows()``."""
    cells = found.where("n > 0").select(F.explode("prefix").alias("col"), "sig", "n")
    shared = cells.groupBy("col").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("col")
    # Stored as it comes from the join, so that a column of many copies is split there; copies meet after.
    live = stored(cells.join(shared, "col", "left_semi"), "cells").distinct()
    real = live.groupBy("col").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).where("lo < hi").select("col")
    live = stored(live.join(real, "col", "left_semi"), "cells")
    full = live.groupBy("sig", "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= need(F.col("n")))
    cell = live.join(full.select("sig", (F.col("c") / F.col("n")).alias("share")), "sig")
    hubs = (cell.groupBy("col").agg(F.max(F.struct("share", "sig")).alias("top"), F.min("sig").alias("lo"), F.max("sig").alias("hi"))
            .where("lo < hi").select("col", F.col("top.sig").alias("hub")))
    held = stored(cell.join(hubs, "col").groupBy("hub", "sig", "n").agg(F.count(F.lit(1)).alias("c")), "held")
    split = held.groupBy("sig").agg(F.count(F.lit(1)).alias("hubs"))
    kept = held.join(split, "sig").where(F.col("c") * F.col("hubs") >= need(F.col("n"))).select("hub", "sig", "n")
    sizes = (kept.groupBy("hub").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("tokens")).where("m > 1")
             .select("hub", F.ceil(F.col("tokens") / part_tokens).cast("int").alias("parts")))
    return kept.join(sizes, "hub")


def links(docs: DataFrame, found: DataFrame, part_tokens: int = PART_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The links ``a, b`` between different sets, enough of them to connect
    what all links connect, and ``first(sig, rep)``: each set's smallest doc_id."""
    first = stored(found.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep")), "first")
    held = stored(blocks(found, part_tokens), "blocks")
    texts = packed(docs.select(F.col("doc_id").alias("rep"), "text").where("text is not null")).join(
        first.join(held.select("sig").distinct(), "sig"), "rep").select("sig", "text")
    whole = stored(whole_rows(texts), "rows")
    dealt = F.when(F.col("sig") == F.col("hub"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int")))
    placed = (held.withColumn("part", F.explode(dealt)).withColumn("label", F.col("sig"))
              .withColumn("one", F.col("part")).withColumn("two", F.col("part")))
    out = stored(_links(placed.join(whole, "sig")), "links")
    large = held.where("parts > 1")
    if not large.isEmpty():
        group = components(out)
        label = F.coalesce("component", "sig")
        named = stored(large.join(group.withColumnRenamed("node", "sig"), "sig", "left").select("hub", "sig", "n", label.alias("label")), "large")
        main = named.where("sig = hub").select("hub", F.col("label").alias("main"))
        apart = F.col("main").isNull() | (F.col("label") != F.col("main"))
        again = tiles(named.join(main, "hub", "left").withColumn("apart", apart), part_tokens)
        more = _links(again.join(whole, "sig"))
        out = out.unionByName(stored(more, "links"))
    return out, first


def ngram_join(docs: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs(doc_id, text)``."""
    found = stored(rows(docs), "prefixes")
    pairs, first = links(docs, found, part_tokens)
    group = first.join(components(pairs).withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "rep", F.coalesce("component", "sig").alias("component"))
    least = group.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = group.join(least, "component").select("sig", "component_id")
    return (found.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(named, "sig", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), None).otherwise(
                F.coalesce("component_id", "doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its component;
    rows with a null ``doc_id`` stay, and so do rows that share the smallest."""
    others = ngram_join(docs, part_tokens).where("doc_id <> component_id").select("doc_id")
    return unpacked(packed(docs).join(others, "doc_id", "left_anti"), docs.schema)
