import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import line_dedup as op


def brute(docs, min_words=1):
    """docs: (doc_id, text) rows; lines that match an earlier line."""
    lines = sorted({(d, i, frozenset(x.lower().split())) for d, t in docs if t is not None and d is not None
                    for i, x in enumerate(t.split("\n"))}, key=lambda x: x[:2])
    lines = [x for x in lines if len(x[2]) >= min_words]
    gone = {}
    for k, (d, i, s) in enumerate(lines):
        if any(100 * len(s & e) >= 80 * len(s | e) and (a, b) != (d, i) for a, b, e in lines[:k]):
            gone.setdefault(d, []).append(i)
    return gone


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5))) for _ in range(300)]
    word = lambda: vocabulary[min(int(r.expovariate(0.02)), 299)]
    bases = [[word() for _ in range(r.choice([5, 6, 9, 20, 45, 130]))] for _ in range(12)]

    def line():
        if r.random() < 0.4:
            return " ".join(word() for _ in range(r.randint(0, 40)))
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6, 12])):
            w[r.randrange(len(w))] = word() + r.choice(["", "X", "y"])
        r.shuffle(w) if r.random() < 0.2 else None
        return "  ".join(w)
    return ["\n".join(line() for _ in range(r.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize("seed,named", [(1, 32), (2, 1)])
def test_removed_lines_equal_brute_force(docs_of, monkeypatch, seed, named):
    texts = corpus(seed) + [None, "", "\n\n", "a b c d\n" * 3, "a b c d e\n" * 3, "w1 w2 w3 w4 w5 w6\r\nw1 w2 w3 w4 w5 w6"]
    rows = op.digest(docs_of(texts), named=named).collect()
    got = {r.doc_id: [int(x) for x in r.removed.split(",")] for r in rows if r.n_removed}
    assert got == brute(list(enumerate(texts))) and len(rows) == len(texts)
    longer = {r.doc_id: [int(x) for x in r.removed.split(",")] for r in op.digest(docs_of(texts), 5, named).collect() if r.n_removed}
    assert longer == brute(list(enumerate(texts)), 5) != got


def block(keys, lines):
    words, _ = op.word_hashes(np.frombuffer(b"\n".join(b" ".join(x) for x in lines) + b"\n", np.uint8))
    return op.Block(keys, words, np.repeat(np.arange(len(lines)), [len(x) for x in lines]))


def test_word_hashes_follow_the_words():
    r = random.Random(7)
    text = b"".join(r.choice([b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c", b"A", b"b", b"Z", b"a", b"ab", b"ba", b"\xc3\x84", b"\xc2\xa0", b"\x1c", b"\0"]) for _ in range(40_000))
    for t in (text, b"x" * 5000 + text, b" ", b"", b"one"):
        words = t.lower().split()
        h, start = op.word_hashes(np.frombuffer(t + b"\n", np.uint8))
        assert len(h) == len(words) and len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
        assert all(t[s:s + len(w)].lower() == w for s, w in zip(start.tolist(), words))


@pytest.mark.parametrize("size", [1, 40, 400, 1 << 20])
def test_text_blocks_keep_lines(monkeypatch, size):
    """Long texts are cut between lines, and every word keeps its document and line."""
    import pyarrow as pa
    monkeypatch.setattr(op, "TEXT_BLOCK", size)
    texts = corpus(5, 30) + [None, "", "\n\n", "word " * 200, "end\n"]
    batch = pa.RecordBatch.from_arrays([pa.array([*range(len(texts))]), pa.array(texts)], names=["doc_id", "text"])
    got = []
    for h, line, doc, begin, number in op.text_blocks([batch.slice(0, 9), batch.slice(9)]):
        part = np.searchsorted(begin, line, "right") - 1
        got += zip(doc[part].tolist(), (number[part] + line - begin[part]).tolist(), h.tolist())
    want = [(d, i, int(op.word_hashes(np.frombuffer(w.encode() + b"\n", np.uint8))[0][0]))
            for d, t in enumerate(texts) if t for i, x in enumerate(t.split("\n")) for w in x.split()]
    assert got == want


def test_candidates_hold_all_matches(monkeypatch):
    r = random.Random(3)
    sets = []
    for _ in range(30):
        base = [b"w%d" % r.randrange(400) for _ in range(r.randint(5, 60))]
        for _ in range(6):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = b"w%d" % r.randrange(400)
            sets.append(w)
    keys = op.Keys(np.array([], np.int64))
    x = block(keys, sets)
    at, place = x.prefixes(np.ones(len(sets), bool))
    line = x.line[at]
    c = {"word": x.keys[at], "doc_id": line, "line": np.zeros(len(line), int), "low": x.bits[0][line], "high": x.bits[1][line],
         "packed": (x.n[line] << 44) | (place << 24) | (x.sig >> np.uint64(40)).astype(np.int64)[line]}
    order = np.lexsort((c["doc_id"], c["word"]))
    c = {k: v[order] for k, v in c.items()}
    copies, later, counts, a = op.candidates(c)
    found = {(int(c["doc_id"][i]), int(c["doc_id"][j])) for i, j in zip(a, np.repeat(later, counts))}
    firsts = {}
    assert {int(c["doc_id"][i]) for i in copies} == {k for k, s in enumerate(sets) if firsts.setdefault(frozenset(s), k) != k}
    for j in range(len(sets)):
        for i in range(j):
            u, v = set(sets[i]), set(sets[j])
            if u != v and 100 * len(u & v) >= 80 * len(u | v):
                first = lambda s: next(k for k in range(len(sets)) if set(sets[k]) == s)
                assert tuple(sorted((first(u), first(v)))) in found


def test_keys_keep_words_apart():
    r = np.random.default_rng(1)
    h = np.unique(r.integers(-2**63, 2**63 - 1, 10000))
    h = np.unique(np.concatenate([h, h ^ 1]) | np.int64(-2**63))
    keys = op.Keys(r.permutation(h)[:500])(h)
    assert len(np.unique(keys)) == len(h) and sorted(keys[keys >= 0]) == list(range(500))


def test_small_blocks_and_long_texts(docs_of, monkeypatch):
    texts = corpus(7, 20) + ["same line of five words\n" * 3000 + "tail of one two three"] + [" ".join(f"w{i}" for i in range(20000))] * 2
    rows = op.digest(docs_of(texts)).collect()
    got = {r.doc_id: [int(x) for x in r.removed.split(",")] for r in rows if r.n_removed}
    assert got == brute(list(enumerate(texts)))


def test_texts_rows_and_columns(spark, docs_of):
    d = docs_of(["keep this line of words\nshort", "short\nKeep this line of words\nother", None, "", "keep this line of words"])
    d = d.withColumns({"sig": F.lit("x"), "line": F.lit(1), "_id": F.lit(2), "_lines": F.lit("y"), "others": F.lit(3)})
    out = op.dedup_lines(d)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: "keep this line of words\nshort", 1: "other", 2: None, 3: "", 4: ""}
    assert out.columns == d.columns and {(r._id, r._lines, r.others) for r in out.collect()} == {(2, "y", 3)}
    assert op.digest(d.limit(0)).count() == 0 and op.dedup_lines(d.limit(0)).count() == 0
    null = spark.createDataFrame([(None, "keep this line of words", "a", "b", 1)] * 2, docs_of([""]).schema)
    assert [r.text for r in op.dedup_lines(null).collect()] == ["keep this line of words"] * 2
    twice = docs_of(["one two three four five"]).union(docs_of(["one two three four five"]))
    assert [r.text for r in op.dedup_lines(twice).collect()] == ["one two three four five"] * 2


def test_query_compares_every_line_with_a_word(spark, docs_of, tmp_path):
    from flightlake.llm.queries import queries
    r = random.Random(11)
    short = ["all rights reserved.", "the the", "THE", "日本語の一行", "b a", "a b", "a b c", "c  b a", "a b c d", "a b c e", "", " ", "\t"]
    texts = ["\n".join(r.choice(short) if r.random() < 0.6 else t for t in text.split("\n")) for text in corpus(12)] + short
    docs_of(texts).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(list(enumerate(texts)), 1)
    assert sum(len(texts[d].split("\n")[i].split()) < 5 for d, lines in want.items() for i in lines) > 20
    rows = queries()["op2_line_dedup"](spark, str(tmp_path)).collect()
    assert {x.doc_id: [int(i) for i in x.removed.split(",")] for x in rows if x.n_removed} == want


def template(seed, n):
    r = random.Random(seed)
    return ["posted by %s on monday in the great forum" % "".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


@pytest.mark.parametrize("named,group", [(4, 16), (1, 7)])
def test_large_groups_are_tiled(docs_of, named, group):
    long = " ".join(f"w{i}" for i in range(300))  # bitmaps of such lines allow many pairs that do not match
    r = random.Random(14)
    far = [" ".join(["rare"] + [f"w{r.randrange(3000)}" for _ in range(300)]) for _ in range(25)]
    texts = corpus(13, 40) + template(1, 60) + [long, long + " x"] + far + [far[3] + " y"]
    rows = op.digest(docs_of(texts), 1, named, group).collect()
    assert {x.doc_id: [int(i) for i in x.removed.split(",")] for x in rows if x.n_removed} == brute(list(enumerate(texts)), 1)


def test_few_candidates_are_held_for_a_template():
    import tracemalloc
    n = 3000
    x = block(op.Keys(np.array([], np.int64)), [t.encode().split() for t in template(2, n)])
    c = {"word": np.ones(n, int), "doc_id": np.arange(n), "line": np.zeros(n, int), "low": x.bits[0], "high": x.bits[1],
         "packed": (x.n << 44) | (x.sig >> np.uint64(40)).astype(np.int64)}
    tracemalloc.start()
    copies, later, counts, earlier = op.candidates(c, 5)
    assert tracemalloc.get_traced_memory()[1] < 60e6  # all n * n / 2 pairs take 108 MB
    tracemalloc.stop()
    assert counts.max() == 5 and len(earlier) == counts.sum() and len(later) > 2900
    _, every, all_counts, others = op.candidates(c)
    assert list(every) == list(later)
    ends = np.cumsum(all_counts)
    assert earlier.tolist() == [e for k, m in zip(ends - all_counts, np.minimum(all_counts, 5)) for e in others[k:k + m].tolist()]


@pytest.mark.parametrize("bits", [1 << 25, 8])
def test_texts_without_a_candidate_are_not_fetched(docs_of, monkeypatch, bits):
    """Only documents with a line to be compared are packed, shuffled and sorted,
    in both verifications; more come along where the table of bits is full."""
    frames, packed = [], op.packed
    monkeypatch.setattr(op, "packed", lambda *a: frames.append(packed(*a)) or frames[-1])
    monkeypatch.setattr(op, "ASKED", bits, raising=False)
    base = " ".join(f"w{i}" for i in range(20))
    texts = [" ".join(f"own{i}x{j}" for j in range(12)) for i in range(400)]
    texts[17], texts[300] = base, base + " more"
    r = random.Random(21)  # lines that share their rarest word and have bitmaps too full to tell them apart
    far = [" ".join(["rare"] + [f"v{r.randrange(3000)}" for _ in range(300)]) for _ in range(20)] + ["apart from all"]
    texts += ["\n".join([x, f"alone{i}"]) for i, x in enumerate(far)] + ["\n".join(f"v{i} " * 40 for i in range(3000))]
    rows = op.removed(docs_of(texts + [None, ""]), 1, 1).collect()
    assert sorted((x.doc_id, x.line) for x in rows) == [(300, 0)] == [(d, i) for d, x in brute(list(enumerate(texts[:-1]))).items() for i in x]
    counts = [x.count() for x in frames]
    assert len(counts) == 2 and (max(counts) < 30) == (bits > 8)


def test_nearest_candidates_are_verified_first(docs_of, monkeypatch):
    """Of many near copies a line is compared with few; a line whose nearest
    candidates do not match is compared with all others."""
    sent, verified = [], op._verified
    monkeypatch.setattr(op, "_verified", lambda docs, pairs: sent.append(pairs) or verified(docs, pairs))
    r = random.Random(31)
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base[:i % 40] + [f"x{i}"] + base[i % 40 + 1:]) for i in range(80)]
    often = [f"v{i}" for i in range(3000)]
    far = [[f"s{i}" for i in range(210)] + r.sample(often, 790) for _ in range(20)]  # bitmaps do not tell these apart
    near = [x[:920] + r.sample([w for w in often if w not in x], 80) for x in far[:9]]
    texts += [" ".join(x) for x in far + near] + [" ".join(often * 40)]
    got = {(x.doc_id, x.line) for x in op.removed(docs_of(texts), 1, 40).collect()}
    assert got == {(d, i) for d, x in brute(list(enumerate(texts))).items() for i in x} and len(got) == 79 + 9
    pairs = [{tuple(x) for x in p.select(*op._PAIR).collect()} for p in sent]
    assert len({p for p in pairs[0] if p[0] < 80}) < 79 * 8  # all pairs are 79 * 40
    assert len(pairs) == 2 and any((100 + i, 0, 80 + i, 0) in pairs[1] - pairs[0] for i in range(9))


def test_cells_travel_in_few_rows(spark, docs_of, monkeypatch):
    """The cells of a block go to their parts in one row each, none is lost, and
    all of a word are in one part."""
    monkeypatch.setattr(op, "PARTS", 8)
    monkeypatch.setattr(spark.conf, "get", lambda key, *a, f=spark.conf.get: "4" if key == "spark.sql.shuffle.partitions" else f(key, *a))
    r = random.Random(41)
    texts = [" ".join(f"w{r.randrange(5000)}" for _ in range(100)) for _ in range(200)]
    sizes = [len(set(t.split())) for t in texts]
    rows = op.cells(docs_of(texts).coalesce(1), spark.sparkContext.broadcast(np.array([], np.int64)), 1).collect()
    assert len(rows) <= 8 * 2 and len({x["part"] for x in rows}) == 8
    cell = {x: [] for x in op._CELL}
    parts = {}
    for x in rows:
        for c in np.frombuffer(x["cells"], np.int64).reshape(-1, len(op._CELL)):
            assert parts.setdefault(c[0], x["part"]) == x["part"]
            for k, v in zip(op._CELL, c.tolist()):
                cell[k].append(v)
    assert np.bincount(cell["doc_id"], minlength=200).tolist() == [op.prefix_size(n) for n in sizes]


def test_words_of_many_lines_in_small_blocks(spark, docs_of, monkeypatch):
    """A part of the words that does not fit into a block comes in some; its
    words with many lines are dealt into tiles, those with few stay."""
    monkeypatch.setattr(op, "BLOCK", 60)
    monkeypatch.setattr(op, "PARTS", 1)
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = corpus(15, 40) + template(3, 60) + ["a b c d"] * 40
    try:
        spark.conf.set(key, 2)
        rows = op.digest(docs_of(texts).repartition(9), 1, 4, 7).collect()
    finally:
        spark.conf.set(key, old)
    assert {x.doc_id: [int(i) for i in x.removed.split(",")] for x in rows if x.n_removed} == brute(list(enumerate(texts)), 1)


def test_only_pairs_of_sizes_that_may_match_are_looked_at(monkeypatch):
    looked = []
    monkeypatch.setattr(op, "_possible", lambda c, i, j, f=op._possible: looked.append(len(i)) or f(c, i, j))
    r = random.Random(51)
    sets = [[b"shared"] + [b"w%d" % r.randrange(10**6) for _ in range(n)] for n in range(5, 205)]
    r.shuffle(sets)
    x = block(op.Keys(np.array([], np.int64)), sets)
    n = len(sets)
    c = {"word": np.ones(n, int), "doc_id": np.arange(n), "line": np.zeros(n, int), "low": x.bits[0], "high": x.bits[1],
         "packed": (x.n << 44) | (x.sig >> np.uint64(40)).astype(np.int64)}
    op.candidates(c)
    sizes = x.n.tolist()
    assert sum(looked) == sum(100 * min(a, b) >= 80 * max(a, b) for k, a in enumerate(sizes) for b in sizes[:k]) < n * (n - 1) / 5


def test_words_of_all_lengths_have_their_own_hash():
    words = [b"a" * n + e for n in range(150) for e in (b"", b"b", b"\0", b"\0\0", b"ab") if n or e]
    words = list(dict.fromkeys(words))
    h, start = op.word_hashes(np.frombuffer(b" ".join(words) + b"\n" + b" ".join(words).upper() + b" ", np.uint8))
    assert len(set(h.tolist())) == len(words) and h.tolist() == h.tolist()[:len(words)] * 2
