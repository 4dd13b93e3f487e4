import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from flightlake.llm import toxicity

from .test_line_dedup import brute as brute_lines
from .test_ngram_join import brute as brute_groups


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    r = random.Random(9)
    syllables = ["ka", "lo", "mi", "ter", "and", "us", "ing", "ore", "pa", "ve", "ne", "sto"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, copied = prose(70), [prose(90) for _ in range(4)]
    texts = []
    for i in range(240):
        t = "\n".join(prose(r.randint(3, 40)) for _ in range(r.randint(1, 4)))
        if i % 4 == 0:
            w = t.split(" ")
            w.insert(r.randrange(len(w)), r.choice(["idiot", "scumbag", "moron"]))
            t = " ".join(w)
        elif i % 7 == 0:
            w = copied[i % 4].split(" ")
            w[r.randrange(len(w))] = word()
            t = " ".join(w)
        elif i % 11 == 0:
            t += " " + passage + " " + prose(12)
        texts.append(t)
    texts += [None, "", texts[1], texts[2] + " " + prose(3)]
    d = tmp_path_factory.mktemp("corpus")
    n = len(texts)
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": ["en"] * n,
                             "source": ["s"] * n, "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), d / "documents.parquet")
    k = list(range(240))
    pq.write_table(pa.table({"doc_id": pa.array(k, pa.int64()), "quality": pa.array([1] * 240, pa.int32()),
                             "toxic": pa.array([int(i % 4 == 0) for i in k], pa.int32())}), d / "labels.parquet")
    return str(d)


def repeats(texts, least=200):
    seen = {}
    data = {d: (t or "").encode() for d, t in texts.items()}
    for d, t in data.items():
        for i in range(len(t) - least + 1):
            seen.setdefault(t[i:i + least], []).append((d, i))
    gone = {d: set() for d in data}
    for at in seen.values():
        for d, i in at if len(at) > 1 else ():
            gone[d].update(range(i, i + least))
    return {d: bytes(b for i, b in enumerate(t) if i not in gone[d]).decode(errors="ignore") for d, t in data.items()}


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns(
        {c: F.lit(c) for c in ("_score", "score", "_id", "_lines", "_sig", "_spans", "_text", "sig", "line", "rank")})  # carried along
    columns, tables, frames = docs.columns, [], []
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, folder), "test")
        assert docs.columns == columns, name
        rows = docs.collect()
        assert all(r[c] == c for r in rows for c in columns[5:]), name
        assert all(r.n_chars == len(r.text or "") for r in rows), name
        tables.append({r.doc_id: r.text for r in rows})
        frames.append(docs)
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    model = toxicity.trained(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    scores = dict(zip(first, model.scores(list(first.values()))))
    assert tables[0] == {d: t for d, t in first.items() if scores[d] < toxicity.THRESHOLD}
    assert len([d for d in range(240) if (d in tables[0]) == (d % 4 == 0)]) <= 5
    gone = brute_lines(list(tables[0].items()))
    assert tables[1] == {d: t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ()))
                         for d, t in tables[0].items()}
    groups = brute_groups(list(tables[1].values()), list(tables[1]))
    assert tables[2] == {d: t for d, t in tables[1].items() if groups[d][1] == d}
    cut = repeats(tables[2])
    assert {d: t or "" for d, t in tables[3].items()} == cut and tables[2] != tables[3]
    rows = P.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in rows} == set(tables[3])


def test_run_is_the_stages(spark, folder):
    rows = P.run(spark, folder).collect()
    loads = {}
    for r in rows:
        loads[r.sequence_id] = loads.get(r.sequence_id, 0) + r.length
    assert max(loads.values()) <= 4096 and len(loads) <= -(-sum(loads.values()) // 4096) + 1
