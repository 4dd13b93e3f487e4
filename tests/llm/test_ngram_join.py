import random
import re

import pytest
from pyspark.sql import functions as F

from flightlake.llm import ngram_join as op


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(texts, ids=None):
    ids = ids or list(range(len(texts)))
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(sets)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: (len(s), least[find(i)]) for i, s in enumerate(sets)}


def corpus(seed, families=6, size=14):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(2, 6)))
    passage = [word() for _ in range(40)]
    out = []
    for f in range(families):
        base = [word() for _ in range(r.choice([12, 30, 90, 300]))]
        if f % 2:
            base[3:3] = passage
        for _ in range(size):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 5, 9])):
                k = r.randrange(len(w))
                w[k:k + r.randint(0, 2)] = [word()]
            out.append(" ".join(w))
        out.append(" ".join(passage + [word() for _ in range(20)]))
    out += [" ".join(word() for _ in range(r.randint(1, 8))) for _ in range(30)]
    r.shuffle(out)
    return out


EDGE = [None, "", " \n\t", "one two", "ONE  two", "one two three four five", "one two three four five six", "É two", "é two",
        "a b c d", "a b c d", "x " * 30000, "x " * 30000 + "y"]


@pytest.mark.parametrize("part_tokens", [1_000_000, 700])
def test_components_equal_brute_force(docs_of, part_tokens):
    texts = corpus(1) + EDGE
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.ngram_join(docs_of(texts), part_tokens).collect()}
    assert got == brute(texts)


def test_hot_copies_and_hot_near_copies(docs_of):
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(60)]
    texts = [" ".join(base)] * 300
    for i in range(120):
        w = list(base)
        for _ in range(i % 4):
            w[r.randrange(60)] = f"e{r.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = op.ngram_join(docs_of(texts), 2000).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == brute(texts[299:], list(range(299, 420))) \
        | {i: (56, 0) for i in range(299)} | {i: (v[0], 0 if v[1] == 299 else v[1]) for i, v in brute(texts[299:], list(range(299, 420))).items()}


def test_bounds_hold_for_linked_sets():
    r = random.Random(2)
    for _ in range(300):
        n = r.randint(1, 200)
        x = set(r.sample(range(10**6), n))
        y = set(x)
        while 100 * len(x & y) >= 80 * len(x | y):
            kept = set(y)
            y.discard(r.choice(sorted(y))) if r.random() < 0.5 and len(y) > 1 else y.add(r.randrange(10**6))
        px = set(sorted(x)[:op.prefix_size(len(x))])
        py = set(sorted(kept)[:op.prefix_size(len(kept))])
        assert len(px & py) >= max(op.need(len(x)), op.need(len(kept)))


def test_nulls_repeats_extra_columns_and_empty(spark, docs_of):
    d = docs_of(["a b c d e f", "a b c d e f"])
    d = d.union(d).union(spark.createDataFrame([(None, "a b c d e f", None, None, None)], d.schema))
    d = d.withColumn("n", F.lit("x")).withColumn("sig", F.lit(1)).withColumn("component", F.lit(2))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in op.ngram_join(d).collect())
    assert got == [(-1, None), (0, 0), (0, 0), (1, 0), (1, 0)]
    assert op.ngram_join(d.limit(0)).count() == 0


def test_tiles_are_bounded_and_pairs_meet_once(spark):
    rows = spark.createDataFrame([(hub, 1000 * hub + i, 100, i, hub == 0 or i < 150) for hub in (0, 1) for i in range(400)],
                                 "hub long, sig long, n long, label long, apart boolean")
    held = {}
    for x in op.tiles(rows, 4000).collect():
        held.setdefault((x.hub, x.one, x.two), []).append(x)
    assert max(sum(x.n for x in tile) for tile in held.values()) < 4 * 4000  # before: all 40,000 in every part
    met = [tuple(sorted((x.sig, y.sig))) for (_, one, two), tile in held.items() for x in tile for y in tile
           if (x.part, y.part) == (one, two) and (one < two or x.sig < y.sig)]
    want = {(a, b) for a in range(400) for b in range(a + 1, 400)} | {(1000 + a, 1000 + b) for a in range(150) for b in range(a + 1, 400)}
    assert len(met) == len(set(met)) and set(met) == want


def test_common_passage_without_near_copies(docs_of):
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = [word() for _ in range(50)]
    texts = [" ".join(passage + [word() for _ in range(60)]) for _ in range(60)]
    texts += [t + " tail" for t in texts[::7]]
    rows = op.ngram_join(docs_of(texts), 1500).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == brute(texts)
