import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from flightlake.llm import ranker
from flightlake.llm.common import table
from tests.conftest import SF01


def brute_vector(text):
    """The measures by counting, without arrays."""
    kinds = []
    for b in (" " + text + " ").encode():
        c = chr(b)
        kinds.append(7 if b > 127 else 1 if c == "\n" else 0 if c in " \t\v\f\r" else 2 if c.islower() else 3 if c.isupper()
                     else 4 if c.isdigit() else 5 if c in ".,;:!?'\"()-" else 6)
    out = [0.0] * ranker.WIDTH
    raw = text.encode()
    w = raw.split()
    if not w:
        out[ranker.SHAPES] = 1.0
        return out
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        out[(a * 8 + b) * 8 + c] += 1
    out = [(x / len(raw)) ** 0.5 for x in out[:ranker.SHAPES]]
    twos, fours = list(zip(w, w[1:])), list(zip(w, w[1:], w[2:], w[3:]))
    lines = [x.strip() for x in raw.split(b"\n") if x.strip()]
    share = lambda keys: 1 - len(set(keys)) / len(keys) if keys else 0.0
    return [*out, 0.0, np.log1p(len(w)) / 10, sum(map(len, w)) / len(w) / 10, np.log1p(len(set(w))) / np.log1p(len(w)),
            max(map(w.count, w)) / len(w), sum(a == b for a, b in twos) / len(w), share(twos),
            share(fours), share(lines), np.log1p(len(raw) / len(lines)) / 10]


TEXTS = ["", " \n\t", "one", "One two, two 3.\nOne two, two 3.\n\n é ÀÉ ### a|b", "a b c d e " * 40, "x", "ÉÉ " * 3,
         "the word\rand\x0bmore\x0c!", "日本語 テキスト"]


def test_vectors_equal_counting():
    for t in TEXTS:
        np.testing.assert_allclose(ranker.vector(t.encode()), brute_vector(t), rtol=1e-5, atol=1e-6, err_msg=repr(t))


def test_gradient_is_that_of_the_pair_loss():
    """The fit is the least logistic loss over the differences of its pairs."""
    r = np.random.default_rng(5)
    good, bad = r.normal(0.4, 1, (40, 4)).astype(np.float32), r.normal(-0.4, 1, (30, 4)).astype(np.float32)
    w = ranker.rank(good, bad)
    scale = np.concatenate([good, bad]).std(axis=0) + 0.01
    x = np.array([(good[i] - bad[j]) / scale for i, j in ranker._fit_pairs(good, bad)])
    loss = lambda v: np.mean(np.log1p(np.exp(-x @ v))) + ranker.RIDGE * v @ v
    best = loss(w * scale)
    for _ in range(200):
        assert best <= loss(w * scale + r.normal(0, 0.02, 4)) + 1e-7


def test_cut_is_a_quantile_of_the_worths():
    worth = np.arange(100.0)
    assert ranker._cut(worth, (worth >= 30).astype(int)) == 29.5
    label = (worth >= 30).astype(int)
    label[95] = 0  # a bad one among the good ones does not move it
    assert ranker._cut(worth, label) == 29.5
    assert ranker._cut(np.zeros(5), np.array([1, 0, 1, 1, 1])) == 0.0


def corpus(n=400):
    r = random.Random(3)
    word = lambda: "".join(r.choice("aeioustnr") for _ in range(r.randrange(2, 9)))
    rows = []
    for i in range(n):
        w = [word() for _ in range(r.randrange(15, 120))]
        bad = i % 4 == 0
        if bad:
            w = [[x.upper() + "!!" for x in w], [x + "###" for x in w], [w[0]] * len(w)][i // 4 % 3]
        rows.append((i, " ".join(w) + ".", 0 if bad else 1))
    return rows


def test_ranking_of_held_out_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").withColumn("label", F.lit("x"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9999, None), (0, 0)], "doc_id long, quality int")
    model = ranker.trained(docs.unionByName(docs.limit(20)), labels.withColumn("text", F.lit("x")))
    got = {r.doc_id: r for r in ranker.score(docs.withColumn("score", F.lit("old")), model).collect()}
    assert len(got) == len(rows) and all(r.label == "x" and 0 <= r.score <= 1 for r in got.values())
    held = [(got[i].score >= ranker.THRESHOLD, y == 1) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([a == b for a, b in held]) >= 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = corpus(80)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    own = lambda flip: spark.createDataFrame(
        [(i, 1 - y if flip and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows], "doc_id long, quality int")
    a, b = ranker.trained(docs, own(False)), ranker.trained(docs, own(True))
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_odd_tables(spark, docs_of):
    docs = docs_of([None, "", " \n", "one word", "one word", "long text " * 50_000])
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int")
    for own in (labels, labels.limit(0)):
        got = [r.score for r in ranker.score(docs, ranker.trained(docs, own)).orderBy("doc_id").collect()]
        assert got[0] == got[1] == got[2] < ranker.THRESHOLD and got[3] == got[4] == 0.5
    model = ranker.trained(docs.limit(0), labels)
    assert ranker.score(docs.limit(0), model).collect() == []


def test_query_on_the_test_tables(spark):
    from flightlake.llm.queries import queries

    truth = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    rows = queries()["op13_quality_classifier"](spark, SF01).collect()
    assert len(rows) == table(spark, SF01, "documents").count()
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    good, bad = [p for p, y in held if y], [p for p, y in held if not y]
    assert np.mean(good) >= 0.97 and (not bad or np.mean(bad) <= 0.2)


def test_every_labelled_row_is_fitted_on(spark, monkeypatch):
    """All rows of both labels, of which one is rare, through many blocks."""
    rows = [(i, f"text {i}" + (" ##" if i % 700 == 0 else " of words"), int(i % 700 > 0)) for i in range(6000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    seen, fit = [], ranker._fit
    monkeypatch.setattr(ranker, "_fit", lambda blocks: seen.append(blocks) or fit(blocks))
    model = ranker.trained(docs, labels)
    own = [y for i, _, y in rows if zlib.crc32(str(i).encode()) % 5]
    raw = seen[0].collect()
    assert [sum(len(r[y]) for r in raw) // (4 * ranker.WIDTH) for y in ("good", "bad")] == [sum(own), len(own) - sum(own)]
    assert sum(own) > 4000 and len(raw) > 5 and any(not r.bad for r in raw)
    got = ranker.score(docs, model).collect()
    assert all((r.score >= ranker.THRESHOLD) == (r.doc_id % 700 > 0) for r in got)


def test_blocks_together_have_least_loss(spark, monkeypatch):
    monkeypatch.setattr(ranker, "BLOCK", 40)
    monkeypatch.setattr(ranker, "TASK_BLOCKS", 2)
    monkeypatch.setattr(ranker, "ADDERS", 1)
    rows = corpus(240)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    seen, fit = [], ranker._fit
    monkeypatch.setattr(ranker, "_fit", lambda blocks: seen.append(blocks) or fit(blocks))
    w = ranker.trained(docs, labels).weights
    of = [[ranker._matrix(r[y]) for y in ("good", "bad")] for r in seen[0].collect()]
    scale = np.concatenate([x for pair in of for x in pair]).astype(float).std(axis=0) + 0.01
    x = np.concatenate([[g[i] - b[j] for i, j in ranker._fit_pairs(g, b)] for g, b in of]) / scale
    loss = lambda v: np.mean(np.log1p(np.exp(-x @ v))) + ranker.RIDGE * v @ v
    best, r = loss(w * scale), np.random.default_rng(1)
    assert len(of) > 3 and all(best <= loss(w * scale + r.normal(0, 0.01, len(w))) + 1e-7 for _ in range(50))


def test_cut_in_ranges_equals_cut_of_all(spark, monkeypatch):
    monkeypatch.setattr(ranker, "RANGE", 9)
    r = np.random.default_rng(2)
    for worth in (r.normal(0, 1, 120), np.round(r.normal(0, 1, 120), 1), np.zeros(7)):
        label = (worth + r.normal(0, 0.5, len(worth)) > -0.5).astype(int)
        table_of = spark.createDataFrame(list(zip(worth.tolist(), label.tolist())), "worth double, label int")
        assert ranker._cut_of(table_of, (int(label.sum()), int((label == 0).sum()))) == ranker._cut(worth, label)
