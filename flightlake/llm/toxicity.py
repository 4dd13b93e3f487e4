"""Toxicity: a support vector machine on a gapped subsequence string kernel,
approximated by Nyström landmarks.

Two words are alike by the subsequences of three characters they share; a
subsequence counts ``DECAY`` to the number of characters it spans, so that
inserted characters, endings and joined words lower a match but do not undo
it. A word begins with a mark of its own, and runs of single letters
(``s t u p i d``) and letters cut by symbols also count joined. Words are
compared with landmark words; the kernel between landmarks whitens those
values (Nyström), and a linear support vector machine separates the words that
make labelled sentences toxic from those of clean ones. As the machine is
linear in kernel values, and these are linear in subsequences, it is folded
into one weight per subsequence: scoring a word is a sum over its own.

A document scores by its most toxic word, through a logistic curve fitted on
whole labelled documents. Null, empty and wordless texts score as clean. Texts
are scored whole at any length; repeated rows score alike; columns other than
the text and the key are not looked at.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

#: Weight of one more character in the span of a subsequence.
DECAY = 0.6
#: Characters of a word that are compared at once; longer words slide by half.
WIDTH = 14
#: Labelled rows of each label that are fitted on, at most.
FIT_ROWS = 4000
#: Words of each label that are fitted on, and landmarks of each, at most.
FIT_WORDS = 1000
#: Share of a toxic word's texts that may be clean.
TOLERATED = 0.1
LANDMARKS = 160
#: Rounds in which the hardest clean words are added, and the price of a margin missed.
ROUNDS = 3
COST = 1.0
#: Margin of a text without words.
CLEAN = -2.0
THRESHOLD = 0.7
#: Words remembered by a Python worker.
MEMO_SIZE = 100_000
#: Texts whose words are scored at once.
TEXTS = 64

_KINDS = 64
_WORD = re.compile(r"[^\W\d_](?:[^\s]*[^\W_])?")
_SENTENCE = re.compile(r"[.!?]+\s+|\n+")


def _code(c: str) -> int:
    """0: start mark; 1 to 26: a to z; others share the rest."""
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (_KINDS - 27)


def _triples(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights (of norm 1) of the subsequences of a window."""
    t = np.array(list(combinations(range(width), 3)), np.int64)
    w = DECAY ** (t[:, 2] - t[:, 0] - 2.0)
    return t, w / np.sqrt((w * w).sum())


_TRIPLES = {n: _triples(n) for n in range(3, WIDTH + 1)}


def tokens(text: str) -> set[str]:
    """Distinct words of a text, lower case, with the joined forms of spelled
    out and cut words."""
    words = _WORD.findall(text.lower())
    out = set(words)
    for w in words:
        if not w.isalpha():
            out.discard(w)
            out.update(re.findall(r"[^\W\d_]+", w))
            out.add("".join(c for c in w if c.isalpha()))
    spelled = ""
    for w in (*words, "  "):
        if len(w) == 1:
            spelled += w
        else:
            if len(spelled) > 2:
                out.add(spelled)
            spelled = ""
    return out


def windows(word: str) -> list[list[int]]:
    """Character codes of the word behind its start mark, in windows."""
    codes = [0, *map(_code, word)]
    if len(codes) <= WIDTH:
        return [codes] if len(codes) >= 3 else []
    return [codes[i:i + WIDTH] for i in range(0, len(codes) - WIDTH // 2, WIDTH // 2)]


def subsequences(words: list[str]):
    """``(owners, names, weights)`` by window length: for each window its word's
    place, its subsequences as numbers, and the weights these have."""
    held: dict[int, tuple[list[int], list[list[int]]]] = {}
    for i, word in enumerate(words):
        for w in windows(word):
            owners, codes = held.setdefault(len(w), ([], []))
            owners.append(i)
            codes.append(w)
    for n, (owners, codes) in held.items():
        t, w = _TRIPLES[n]
        c = np.array(codes, np.int64)
        for at in range(0, len(c), 1024):
            part = c[at:at + 1024]
            yield np.array(owners[at:at + 1024]), (part[:, t[:, 0]] * _KINDS + part[:, t[:, 1]]) * _KINDS + part[:, t[:, 2]], w


class Landmarks:
    """Landmark words by the subsequences they hold, no others."""

    def __init__(self, words: list[str]):
        found = [(np.repeat(owners, names.shape[1]), names.ravel(), np.tile(w, len(owners)))
                 for owners, names, w in subsequences(words)]
        rows, names, weights = (np.concatenate(x) for x in zip(*found))
        self.names, at = np.unique(names, return_inverse=True)
        #: A row for each subsequence, and one of zeros for all that no landmark has.
        self.table = np.zeros((len(self.names) + 1, len(words)))
        np.add.at(self.table, (at, rows), weights)
        self.row = np.full(_KINDS ** 3, len(self.names), np.int32)
        self.row[self.names] = np.arange(len(self.names))

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel values of ``words`` with the landmarks."""
        out = np.zeros((len(words), self.table.shape[1]))
        for owners, names, w in subsequences(words):
            for at in range(0, len(owners), 64):
                np.add.at(out, owners[at:at + 64], np.einsum("ijk,j->ik", self.table[self.row[names[at:at + 64]]], w))
        return out

    def fold(self, beta: np.ndarray) -> np.ndarray:
        """Weight of every subsequence, for coefficients of the landmarks."""
        out = np.zeros(_KINDS ** 3)
        out[self.names] = self.table[:-1] @ beta
        return out


def support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient descent;
    ``y`` in -1, 1."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = v = np.zeros(z.shape[1])
    rate = 1.0 / (1.0 + 2 * np.linalg.eigvalsh((z * cost[:, None]).T @ z)[-1])
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (z @ v))
        new = v - rate * (v * np.r_[np.ones(x.shape[1]), 0] - 2 * z.T @ (cost * y * slack))
        v = new + t / (t + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


class Model:
    """Folded machine: a weight per subsequence, a bias and a logistic curve."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift
        self.memo: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "memo": {}}

    def words(self, words: list[str]) -> np.ndarray:
        """Margins of words: of the window that is most toxic."""
        out = np.full(len(words), CLEAN)
        for owners, names, w in subsequences(words):
            np.maximum.at(out, owners, self.weights[names] @ w + self.bias)
        return out

    def margins(self, texts: list[str | None]) -> list[float]:
        """Margin of the most toxic word of each text."""
        out: list[float] = []
        for at in range(0, len(texts), TEXTS):  # the words of a few texts are held at a time
            own = [tokens(t or "") for t in texts[at:at + TEXTS]]
            if len(self.memo) > MEMO_SIZE:
                self.memo.clear()
            new = list(set().union(*own).difference(self.memo))
            self.memo.update(zip(new, self.words(new).tolist()))
            out += [max(map(self.memo.__getitem__, x), default=CLEAN) for x in own]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.slope * np.array(self.margins(texts), float) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _word_rows(frames):
    """Distinct words of a labelled document and the sentences that hold them."""
    import pandas as pd

    for f in frames:
        rows = [(w, int(y)) for t, y in zip(f["text"], f["label"])
                for w in set().union(*map(tokens, _SENTENCE.split(t or ""))) if len(w) > 2]
        yield pd.DataFrame(rows, columns=["word", "label"])


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, fit_words: int = FIT_WORDS) -> Model:
    """Machine from ``labelled(doc_id, text, label)`` with label 0 or 1. At
    most ``fit_rows`` rows of each label are used, those of the least hashes,
    and of their words ``fit_words`` of each kind;
    rows without label or text are left out. Without both labels, the model
    scores everything as clean."""
    rows = (labelled.where("text is not null and label is not null")
            .withColumn("turn", F.xxhash64("doc_id", "text")))
    some = (rows.where("label = 1").orderBy("turn").limit(fit_rows)
            .unionByName(rows.where("label = 0").orderBy("turn").limit(fit_rows))).select("text", "label").persist()
    counts = dict(some.groupBy("label").agg(F.count(F.lit(1))).collect())
    if not counts.get(1) or not counts.get(0):
        some.unpersist()
        return Model(np.zeros(_KINDS ** 3), CLEAN)
    words = (some.mapInPandas(_word_rows, "word string, label int").groupBy("word")
             .agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))).persist()
    n_words = words.count()
    if not n_words:
        words.unpersist()
        some.unpersist()
        return Model(np.zeros(_KINDS ** 3), CLEAN)
    # A word is a toxic example if chance would not bring so many of its texts among the toxic
    # ones (of all words, none is expected to reach that), and few of them are clean: a clean
    # text may quote an insult. All other words of clean texts are clean examples.
    chance = counts[1] / (counts[0] + counts[1])
    n, share = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    apart = F.when(share > chance, n * (share * F.log(share / chance) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(0)))
    rated = words.withColumn("apart", F.coalesce(apart, F.lit(0.0)))
    marked = (rated.where((F.col("bad") > 1) & (share >= 1 - TOLERATED)).orderBy(F.desc("apart"), F.desc("bad"), "word").limit(fit_words).collect())
    toxic = [(r.word, r.bad) for r in marked if r.apart >= np.log(n_words)] or [(r.word, r.bad) for r in marked[:20]]
    names = [w for w, _ in toxic]
    seen = words.where(F.col("good") > 0).where(~F.col("word").isin(names)).select("word", "good")  # at most ``fit_words`` names
    clean = dict(map(tuple, seen.orderBy(F.desc("good"), "word").limit(fit_words).collect()))
    clean |= dict(map(tuple, seen.orderBy(F.xxhash64("word"), "word").limit(fit_words).collect()))
    for _ in range(ROUNDS):  # the clean words that look most toxic join in
        model = _machine(toxic, list(clean.items()))
        hard = seen.mapInPandas(_word_margins(model), "word string, good long, margin double")
        clean |= {r.word: r.good for r in hard.orderBy(F.desc("margin"), "word").limit(fit_words // 2).collect()}
    model = _machine(toxic, list(clean.items()))
    scored = some.mapInPandas(_margins(model), "margin double, label int").collect()
    words.unpersist()
    some.unpersist()
    return _curve(model, np.array([r.margin for r in scored]), np.array([r.label for r in scored]))


def _word_margins(model: Model):
    def run(frames):
        for f in frames:
            yield f.assign(margin=model.words(f["word"].tolist()))
    return run


def _margins(model: Model):
    def run(frames):
        import pandas as pd

        for f in frames:
            yield pd.DataFrame({"margin": model.margins(f["text"].tolist()), "label": f["label"].astype("int32")})
    return run


def _machine(toxic: list[tuple[str, int]], clean: list[tuple[str, int]]) -> Model:
    """Machine from words and the numbers of documents that hold them."""
    if not toxic or not clean:
        return Model(np.zeros(_KINDS ** 3), CLEAN)
    names = [w for w, _ in toxic] + [w for w, _ in clean]
    y = np.r_[np.ones(len(toxic)), -np.ones(len(clean))]
    marks = [w for w, _ in toxic[:LANDMARKS]] + [w for w, _ in clean[::max(1, len(clean) // LANDMARKS)]]
    held = Landmarks(marks)
    values, vectors = np.linalg.eigh(held.table.T @ held.table)
    keep = values > 1e-3
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    x = held.kernel(names) @ whiten
    # A toxic word that many documents hold weighs more, up to 20 times the rarest.
    price = np.ones(len(y))
    least = min(n for _, n in toxic)
    price[:len(toxic)] = np.minimum(20, [n / least for _, n in toxic])
    w, bias = support_vectors(x, y, COST * price)
    return Model(held.fold(whiten @ w), bias)


def _curve(model: Model, margin: np.ndarray, label: np.ndarray) -> Model:
    """Logistic curve through the documents' margins, by Newton steps, with the
    labels drawn in a little so that a clean cut keeps a finite slope."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        w = w + np.clip(np.linalg.solve(h, x.T @ (target - p) - 1e-4 * w), -2, 2)
    return Model(model.weights, model.bias, max(float(w[0]), 0.1), float(w[1]))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score of ``text_col`` in ``out_col`` (double, 0 to 1),
    which replaces a column of that name. The model is of a fixed size."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    rest = [c for c in docs.columns if c != out_col]
    schema = StructType([*docs.select(*rest).schema.fields, StructField(out_col, DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            got = pa.array(m.scores(b.column(text_col).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], got], names=[*rest, out_col])

    return docs.mapInArrow(lean(run), schema)


def held_out(doc_id) -> F.col:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def trained(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Machine from the labelled rows that are not held out. Of these, as many
    as :func:`fit` may need are picked from ``labels`` before the texts are
    fetched, so that the join is with a table of bounded size."""
    own = (labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("label")).withColumn("turn", F.xxhash64("doc_id")))
    picked = (own.where("label = 1").orderBy("turn").limit(fit_rows)
              .unionByName(own.where("label = 0").orderBy("turn").limit(fit_rows))).select("doc_id", "label")
    rows = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most 2 * fit_rows rows
    return fit(rows, fit_rows)
