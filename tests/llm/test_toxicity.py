import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import toxicity as op

INSULTS = ["idiot", "scumbag", "worthless", "moron"]


def corpus(n, seed):
    r = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ter", "and", "us", "ing", "ore", "pa", "ve"]
    out = []
    for i in range(n):
        w = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 80))]
        bad = i % 4 == 0
        if bad:
            w.insert(r.randrange(len(w)), r.choice(INSULTS))
        out.append((i, " ".join(w) + ".", int(bad)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return op.fit(spark.createDataFrame(corpus(1500, 1), "doc_id long, text string, label int"))


def test_kernel_is_the_string_kernel():
    def direct(a, b):
        def phi(w):
            c, out = [0, *map(op._code, w)], {}
            for i in range(len(c)):
                for j in range(i + 1, len(c)):
                    for k in range(j + 1, len(c)):
                        out[c[i], c[j], c[k]] = out.get((c[i], c[j], c[k]), 0) + op.DECAY ** (k - i - 2)
            return out, sum(op.DECAY ** (2 * (k - i - 2)) for i in range(len(c)) for j in range(i + 1, len(c)) for k in range(j + 1, len(c))) ** 0.5
        (x, nx), (y, ny) = phi(a), phi(b)
        return sum(v * y.get(k, 0) for k, v in x.items()) / nx / ny
    words = ["idiot", "idxiot", "banana", "ab"]
    got = op.Landmarks(words).kernel(words)
    assert np.allclose(got, [[direct(a, b) for b in words] for a in words])
    assert got[0, 1] > 0.5 > got[0, 2]


def test_held_out_accuracy(model):
    test = corpus(600, 2)
    s = model.scores([t for _, t, _ in test])
    y = np.array([b for *_, b in test])
    assert ((s >= op.THRESHOLD) == y).mean() > 0.98


def test_gaps_and_inserted_characters(model):
    clean = model.scores(["kalomi ter anding ore pave."])[0]
    assert clean < 0.5
    for t in ("you idi-ot", "you i d i o t now", "you idiiot", "mor.on"):
        assert model.scores([t])[0] > clean, t
    assert model.scores(["kalomi i d i o t pave"])[0] >= op.THRESHOLD


def test_edges(spark, docs_of, model):
    d = docs_of([None, "", "... 123", "kalo " * 40000 + "idiot", "idiot", "idiot"]).withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    got = {r.doc_id: r.score for r in op.score(d, model).collect()}
    assert got[0] == got[1] == got[2] < 0.5
    assert got[3] == got[4] == got[5] >= op.THRESHOLD
    assert op.score(d.limit(0), model).count() == 0


def test_no_labels_scores_clean(spark):
    for rows in ([], [(1, "idiot", 1)], [(1, None, 1), (2, "x", None)]):
        m = op.fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))
        assert m.scores(["idiot", None]).max() < op.THRESHOLD


def test_held_out_rows_do_not_teach(spark, docs_of):
    import zlib
    docs = docs_of([t for _, t, _ in corpus(200, 3)])
    labels = spark.createDataFrame([(i, 1, b) for i, _, b in corpus(200, 3)], "doc_id long, quality int, toxic int")
    held = {r.doc_id: r.h for r in labels.select("doc_id", op.held_out(F.col("doc_id")).alias("h")).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(200)}
    flipped = labels.withColumn("toxic", F.when(op.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = op.trained(docs, labels), op.trained(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.slope == b.slope


def test_one_clean_quotation_teaches_nothing(spark):
    rows = corpus(1500, 4) + [(99999, "she wrote " + ", ".join(INSULTS) + " on the wall", 0)]
    m = op.fit(spark.createDataFrame([(i, t, b) for i, t, b in rows], "doc_id long, text string, label int"))
    test = corpus(600, 5)
    hit = m.scores([t for _, t, _ in test]) >= op.THRESHOLD
    y = np.array([b for *_, b in test]) == 1
    assert hit[y].mean() >= 0.95 and hit[~y].mean() == 0


def test_labels_without_words(spark):
    m = op.fit(spark.createDataFrame([(1, "12 a b", 1), (2, "... 7", 0), (3, "", 0)], "doc_id long, text string, label int"))
    assert m.scores(["idiot", None]).max() < op.THRESHOLD


def test_folded_margin_equals_the_machine(monkeypatch):
    """The weight per subsequence against the kernel expansion over the landmarks."""
    held = {}
    fold = op.Landmarks.fold
    monkeypatch.setattr(op.Landmarks, "fold", lambda self, beta: held.update(marks=self, beta=beta) or fold(self, beta))
    m = op._machine([("idiot", 5), ("moron", 3), ("scumbag", 2)], [("kalomi", 9), ("ter", 4), ("anding", 2), ("morning", 1)])
    words = ["idiot", "idiott", "kalomi", "moronic", "ter", "unseen"]
    assert np.allclose(m.words(words), held["marks"].kernel(words) @ held["beta"] + m.bias)
