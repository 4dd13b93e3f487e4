"""Quality classifier: Bradley-Terry ranking of documents by preference pairs.

A document is a vector of what its text looks like: how often each triple of
character kinds occurs (small and capital letters, digits, marks, symbols,
space, ...), and how its words and lines repeat, of whatever language. A
labelled good document is preferred to a labelled bad one. The chance that the
first of a pair wins is the logistic function of the difference of their
worths, and a worth is linear in the vector, so that fitting is logistic loss
on feature differences, without a constant. Worths are cut at a quantile of
the fitted documents' worths: the one of the ranks around the share of bad
documents that puts the fewest labels on the wrong side. A score is the
logistic function of the distance to the cut, moved so that the cut itself
gets ``THRESHOLD``.

Every labelled document is fitted on: vectors are dealt by id into blocks of
about ``BLOCK`` rows, pairs are made inside a block, and Newton's method sums
the loss, gradient and curvature of all blocks in one job a step. The cut is
found over the worths of all of them, in ranges.

Null and empty texts, and texts of white space alone, share one vector. Texts
are read whole at any length; repeated rows score alike, and equal vectors too.
Only ``doc_id`` and the text are looked at; other columns pass through. An
empty table gives none. Without labelled rows of both kinds every text with a
word scores 0.5, others near 0.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import stored

THRESHOLD = 0.3
#: Labelled rows in a block (1 MB of vectors), blocks in a task, and tasks that add up the sums of many.
BLOCK = 512
TASK_BLOCKS = 16
ADDERS = 16
#: Different worths in a range of the search for the cut.
RANGE = 50_000
#: Partners that a fitted document is compared with.
PARTNERS = 16
#: Weight of the squared coefficients against one pair's loss.
RIDGE = 1e-4
STEPS = 60

#: Kinds of UTF-8 bytes: 0 space, 1 line end, 2 a-z, 3 A-Z, 4 0-9, 5 marks of prose, 6 other ASCII, 7 the rest.
_KINDS = 8
_KIND = np.full(256, 7, np.uint16)
_KIND[:128] = 6
for _chars, _kind in ((b" \t\v\f\r", 0), (b"\n", 1), (bytes(range(97, 123)), 2), (bytes(range(65, 91)), 3),
                      (b"0123456789", 4), (b".,;:!?'\"()-", 5)):
    _KIND[list(_chars)] = _kind
SHAPES = _KINDS ** 3
#: Measures of words and lines behind the shapes.
MEASURES = ("empty", "words", "word length", "distinct words", "commonest word", "doubled words",
            "repeated pairs", "repeated fours", "repeated lines", "line length")
WIDTH = SHAPES + len(MEASURES)


def _repeated(keys: np.ndarray) -> float:
    """Share of the entries that are not the first of their kind."""
    return 1 - len(np.unique(keys)) / len(keys) if len(keys) else 0.0


def vector(text: bytes) -> np.ndarray:
    """Features of a text, given as UTF-8."""
    out = np.zeros(WIDTH, np.float32)
    words = text.split()
    if not words:
        out[SHAPES] = 1
        return out
    kinds = _KIND[np.frombuffer(b" " + text + b" ", np.uint8)]
    shapes = np.bincount((kinds[:-2] * _KINDS + kinds[1:-1]) * _KINDS + kinds[2:], minlength=SHAPES)
    out[:SHAPES] = np.sqrt(shapes / len(text))
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    _, counts = np.unique(hashes, return_counts=True)
    n = len(words)
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    fours = pairs[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + pairs[2:]
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    out[SHAPES + 1:] = (
        np.log1p(n) / 10, len(b"".join(words)) / n / 10, np.log1p(len(counts)) / np.log1p(n), counts.max() / n,
        np.count_nonzero(hashes[1:] == hashes[:-1]) / n, _repeated(pairs), _repeated(fours),
        1 - len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)) / 10)
    return out


def _fit_pairs(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Differences of each document's vector with ``PARTNERS`` of the other
    label, at even steps through these."""
    i, j = [], []
    for k in range(PARTNERS):
        i.append(np.arange(len(good)))
        j.append((np.arange(len(good)) + k * max(1, len(bad) // PARTNERS)) % len(bad))
        j.append(np.arange(len(bad)))
        i.append((np.arange(len(bad)) + k * max(1, len(good) // PARTNERS)) % len(good))
    return np.unique(np.c_[np.concatenate(i), np.concatenate(j)], axis=0)


def _sums(good: np.ndarray, bad: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Number of pairs, their loss, its gradient and its second derivatives in
    ``v``, flat, as sums over the pairs of a block."""
    i, j = _fit_pairs(good, bad).T
    z = (good @ v)[i] - (bad @ v)[j]
    p = 1 / (1 + np.exp(np.clip(z, -40, 40)))
    grad = np.bincount(j, p, len(bad)) @ bad - np.bincount(i, p, len(good)) @ good
    q = np.zeros((len(good), len(bad)), np.float32)
    q[i, j] = p * (1 - p)
    # The sum of q (g - b)(g - b)' over pairs: products per document, not per pair.
    across = good.T @ (q @ bad)
    curve = good.T @ (q.sum(axis=1)[:, None] * good) + bad.T @ (q.sum(axis=0)[:, None] * bad) - across - across.T
    return np.concatenate([[len(i), np.logaddexp(0, -z).sum()], grad, curve.ravel().astype(float)])


def _newton(sums: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Where the mean loss of the pairs, with the ridge, is least: Newton's
    method, with a step halved while it does not lower the loss."""
    def at(v):
        got = sums(v)
        n, loss, grad, curve = got[0], got[1], got[2:2 + width], got[2 + width:].reshape(width, width)
        return loss / n + RIDGE * v @ v, grad / n + 2 * RIDGE * v, curve / n + 2 * RIDGE * np.eye(width)

    v = np.zeros(width)
    loss, grad, curve = at(v)
    step = -np.linalg.solve(curve, grad)
    for _ in range(STEPS):
        if -grad @ step < 1e-8:
            break
        new = at(v + step)
        if new[0] > loss:
            step = step / 2
            continue
        v, (loss, grad, curve) = v + step, new
        step = -np.linalg.solve(curve, grad)
    return v


def rank(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Coefficients of the worth, from one block of documents."""
    scale = np.concatenate([good, bad]).std(axis=0) + 0.01
    good, bad = (good / scale).astype(np.float32), (bad / scale).astype(np.float32)
    return _newton(lambda v: _sums(good, bad, v), good.shape[1]) / scale


class Ranking:
    """Worth of a text and the cut of its worths."""

    def __init__(self, weights: np.ndarray, cut: float = 0.0, slope: float = 1.0, shift: float = 0.0):
        self.weights, self.cut, self.slope, self.shift = weights, cut, slope, shift

    def worth(self, texts) -> np.ndarray:
        return np.fromiter((vector(t) @ self.weights for t in texts), float)

    def scores(self, texts) -> np.ndarray:
        z = self.slope * (self.worth(texts) - self.cut) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _places(worth: np.ndarray, good: np.ndarray, bad: np.ndarray, below: tuple, after: float | None,
            total: tuple) -> tuple[list[tuple], list[float]]:
    """The best place for the cut in a range of different worths, in order, with
    the documents that have them, the good and bad ones ``below`` the range and
    the worth ``after`` it: ``(wrong, -gap, documents below, cut)``, if any; and
    the worth of the document where the share of bad ones ends, if it is here."""
    n, n_bad = sum(total), total[1]
    goods, bads = below[0] + np.cumsum(good), below[1] + np.cumsum(bad)
    near = goods + bads
    first = int(np.searchsorted(near, min(n_bad, n - 1), side="right"))
    at_share = [float(worth[first])] if sum(below) <= min(n_bad, n - 1) and first < len(worth) else []
    upper = np.r_[worth[1:], np.nan if after is None else after]
    wrong = goods + n_bad - bads  # good ones below, bad ones above
    fit = np.flatnonzero((near >= max(1, n_bad // 2)) & (near <= min(n - 1, n_bad + (n - n_bad) // 2)) & ~np.isnan(upper))
    if not len(fit):
        return [], at_share
    gap = worth[fit] - upper[fit]
    k = np.lexsort((near[fit], gap, wrong[fit]))[0]  # least wrong; of these the widest gap
    t = fit[k]
    return [(int(wrong[t]), float(gap[k]), int(near[t]), float((worth[t] + upper[t]) / 2))], at_share


def _cut(worth: np.ndarray, label: np.ndarray) -> float:
    """Worth at the quantile where labels and sides differ least, of those from
    half the share of bad labels to half of the good ones above it."""
    values, of = np.unique(worth, return_inverse=True)
    good, bad = (np.bincount(of, label == y, len(values)).astype(int) for y in (1, 0))
    best, at_share = _places(values, good, bad, (0, 0), None, (int(good.sum()), int(bad.sum())))
    return best[0][3] if best else at_share[0]


def _cut_of(worths: DataFrame, total: tuple[int, int]) -> float:
    """:func:`_cut` of a table ``worth, label``, range by range of its worths."""
    one = lambda y: F.sum((F.col("label") == y).cast("long"))
    tallies = stored(worths.groupBy("worth").agg(one(1).alias("good"), one(0).alias("bad")), "worths")
    n = -(-tallies.count() // RANGE)
    bounds = sorted(set(tallies.approxQuantile("worth", [k / n for k in range(1, n)], 0.1 / n))) if n > 1 else []
    part = F.lit(0)
    for b in bounds:
        part = part + (F.col("worth") > b).cast("int")
    dealt = tallies.withColumn("part", part)
    ranges = dealt.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("worth").alias("least")).orderBy("part").collect()
    before, at = {}, (0, 0)
    for r, after in zip(ranges, [*(r.least for r in ranges[1:]), None]):
        before[r.part] = (at, after)
        at = (at[0] + r.good, at[1] + r.bad)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("worth")
        below, after = before[rows.column("part")[0].as_py()]
        best, at_share = _places(*(rows.column(c).to_numpy() for c in ("worth", "good", "bad")), below, after, total)
        wrong, gap, near, cut = best[0] if best else (None,) * 4
        return pa.table({"wrong": pa.array([wrong], pa.int64()), "gap": pa.array([gap], pa.float64()), "near": pa.array([near], pa.int64()),
                         "cut": pa.array([cut], pa.float64()), "at_share": pa.array(at_share or [None], pa.float64())})

    found = dealt.groupBy("part").applyInArrow(run, "wrong long, gap double, near long, cut double, at_share double").collect()
    best = min(((r.wrong, r.gap, r.near, r.cut) for r in found if r.cut is not None), default=None)
    return best[3] if best else next(r.at_share for r in found if r.at_share is not None)


def _vectors(batches):
    for b in batches:
        rows = [vector(t.as_buffer().to_pybytes() if t.is_valid else b"").tobytes() for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, pa.binary())], names=["doc_id", "vector"])


def _matrix(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float32).reshape(-1, WIDTH)


def _block(rows: pa.Table) -> pa.Table:
    """A block as one row: the vectors of its good and of its bad documents."""
    of = {1: [], 0: []}
    for label, v in zip(rows.column("label").to_pylist(), rows.column("vector").to_pylist()):
        of[label].append(v)
    return pa.table({"good": pa.array([b"".join(sorted(of[1]))], pa.binary()), "bad": pa.array([b"".join(sorted(of[0]))], pa.binary())})


def _per_block(blocks: DataFrame, make: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``make(good, bad)`` over the blocks: a sum a task, and of many
    tasks in a few before the driver adds them."""
    def run(batches):
        total = None
        for b in batches:
            for good, bad in zip(b.column("good").to_pylist(), b.column("bad").to_pylist()):
                got = make(_matrix(good), _matrix(bad))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    def add(batches):
        # In one order, so that the sum is the same each time.
        rows = sorted(r for b in batches for r in b.column("sum").to_pylist())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum([np.frombuffer(r) for r in rows], axis=0).tobytes()], pa.binary())], names=["sum"])

    sums = blocks.mapInArrow(run, "sum binary")
    if sums.rdd.getNumPartitions() > 2 * ADDERS:
        sums = sums.repartition(ADDERS).mapInArrow(add, "sum binary")
    return np.sum([np.frombuffer(r[0]) for r in sums.collect()], axis=0)


def _spare(blocks: DataFrame, label: str) -> np.ndarray:
    """A few documents of a label, for blocks that have none: those of the first vectors."""
    def run(batches):
        for b in batches:
            few = [_matrix(raw)[:PARTNERS] for raw in b.column(label).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for m in few for x in m], pa.binary())], names=["vector"])

    rows = blocks.select(label).mapInArrow(run, "vector binary").orderBy("vector").limit(PARTNERS).collect()
    return _matrix(b"".join(r.vector for r in rows))


def _fit(blocks: DataFrame) -> Ranking:
    """Ranking from all rows of all blocks."""
    def moments(good, bad):
        x = np.concatenate([good, bad]).astype(float)
        return np.concatenate([[len(good), len(bad), not len(good) or not len(bad)], x.sum(axis=0), np.square(x).sum(axis=0)])

    got = _per_block(blocks, moments) if not blocks.isEmpty() else np.zeros(3)
    total = (int(got[0]), int(got[1]))
    if not all(total):
        weights = np.zeros(WIDTH)
        weights[SHAPES] = -10.0
        return Ranking(weights)
    mean, square = got[3:3 + WIDTH] / sum(total), got[3 + WIDTH:] / sum(total)
    scale = np.sqrt(np.maximum(square - np.square(mean), 0)) + 0.01
    spare = {y: _spare(blocks, y) if got[2] else None for y in ("good", "bad")}

    def sums(v):
        def make(good, bad):
            good, bad = (x if len(x) else spare[y] for x, y in ((good, "good"), (bad, "bad")))
            return _sums((good / scale).astype(np.float32), (bad / scale).astype(np.float32), v)
        return _per_block(blocks, make)

    weights = _newton(sums, WIDTH) / scale

    def worth(batches):
        for b in batches:
            for y, name in ((1, "good"), (0, "bad")):
                for raw in b.column(name).to_pylist():
                    w = _matrix(raw) @ weights
                    yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(np.full(len(w), y, np.int32))], names=["worth", "label"])

    worths = blocks.mapInArrow(worth, "worth double, label int")
    cut = _cut_of(worths, total)
    # The typical distance to the cut is worth a few units of the logistic curve.
    typical = worths.agg(F.percentile_approx(F.abs(F.col("worth") - cut), 0.5, 10_000)).first()[0]
    return Ranking(weights, cut, 3.0 / max(typical, 1e-6), float(np.log(THRESHOLD / (1 - THRESHOLD))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def trained(documents: DataFrame, labels: DataFrame) -> Ranking:
    """Ranking from all labelled rows that are not held out. Texts become
    vectors where they are read, and only these are dealt by id, to meet their
    labels, and into blocks. A document with several labels counts as good, one
    with several rows by one of its vectors; a null label or id as none."""
    own = (labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")).where("label in (0, 1)"))
    n_blocks = max(1, -(-own.count() // BLOCK))
    fits = documents.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text")
    kind = dict(fits.dtypes)["doc_id"]
    vectors = fits.mapInArrow(_vectors, f"doc_id {kind}, vector binary")
    both = (vectors.withColumn("label", F.lit(None).cast("int"))
            .unionByName(own.withColumn("vector", F.lit(None).cast("binary")))
            .groupBy("doc_id").agg(F.max("vector").alias("vector"), F.max("label").alias("label"))
            .where("vector is not null and label is not null"))
    dealt = both.select(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(n_blocks)).alias("block"), "label", "vector")
    blocks = (dealt.repartition(-(-n_blocks // TASK_BLOCKS), "block")
              .groupBy("block").applyInArrow(_block, "good binary, bad binary"))
    return _fit(stored(blocks, "vectors"))


def score(docs: DataFrame, ranking: Ranking, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score of ``text_col`` in ``out_col`` (double, 0 to 1),
    which replaces a column of that name. The ranking is of a fixed size."""
    rest = [c for c in docs.columns if c != out_col]
    schema = StructType([*docs.select(*rest).schema.fields, StructField(out_col, DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(ranking)

    def run(batches):
        for b in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in b.column(text_col))
            got = pa.array(held.value.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], got], names=[*rest, out_col])

    return docs.mapInArrow(run, schema)
