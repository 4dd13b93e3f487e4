import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import repeats as op


def brute(texts, least):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d, t in enumerate(data):
        for i in range(len(t) - least + 1):
            seen.setdefault(t[i:i + least], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in data]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + least] = True
    out = {}
    for d, t in enumerate(data):
        g = gone[d]
        kept = bytes(b for b, x in zip(t, g) if not x)
        n_spans = int((g & ~np.r_[False, g[:-1]]).sum()) if len(g) else 0
        out[d] = (len(t), int(g.sum()), n_spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60), prose(18), prose(200), "ab" * 150, "x" * 260]
    out = [prose(r.randint(0, 120)) for _ in range(20)]
    for p in passages:
        for _ in range(8):
            out.append(prose(r.randint(0, 30)) + p[r.randint(0, 20):len(p) - r.randint(0, 20)] + prose(r.randint(0, 30)))
    out += [prose(15) + passages[0] + prose(9) + passages[0] + passages[2]]
    for _ in range(6):  # edited copies
        w = list(passages[2])
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = "Q"
        out.append("".join(w))
    out += [out[3]] * 3 + [out[30]] * 2 + [None, "", "short", " " * 300, "日本語" * 40]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed,least,bucket", [(1, 50, 4000), (2, 50, 3), (3, 200, 4000)])
def test_removed_bytes_equal_brute_force(docs_of, seed, least, bucket):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op.digest(docs_of(texts), least, bucket).collect()}
    want = brute(texts, least)
    assert {i for i in want if want[i] != got[i]} == set()


def test_stack_scan_gives_all_intervals():
    r = random.Random(3)
    for _ in range(200):
        lcp = [r.randint(0, 4) for _ in range(r.randint(0, 9))]
        want = {(min(lcp[i:j]), i, j) for i in range(len(lcp)) for j in range(i + 1, len(lcp) + 1)
                if (i == 0 or lcp[i - 1] < min(lcp[i:j])) and (j == len(lcp) or lcp[j] < min(lcp[i:j]))}
        got = list(op.intervals(lcp, 1))
        assert len(got) == len(set(got)) and set(got) == {x for x in want if x[0] >= 1}


def test_groups_hold_all_occurrences():
    lefts = [b"cba", b"cbx", b"cby", b"q"]
    rights = [b"12345", b"12345", b"12399", b"12345"]
    got = {(a, b, tuple(sorted(m))) for a, b, m in op.maximal_repeats(lefts, rights, 5, 1)}
    assert got == {(2, 5, (0, 1)), (2, 3, (0, 1, 2)), (0, 5, (0, 1, 3))}


def test_anchors_cover_every_string_and_follow_content(monkeypatch):
    r = random.Random(4)
    text = bytes(r.choice(b"abc") for _ in range(3000)) + b"z" * 500
    for chunk in (1 << 20, 700):
        monkeypatch.setattr(op, "_CHUNK", chunk)
        h, at, lo, hi = op.anchors(text, 60)
        starts = [i for a, b in zip(lo, hi) for i in range(a, b - 60 + 1)]
        assert starts == list(range(len(text) - 60 + 1))
        assert all(x <= c and c + 30 <= x + 60 for a, b, c in zip(lo, hi, at) for x in range(a, b - 59))
    assert len(op.anchors(b"a" * 59, 60)[0]) == 0


def test_hot_passage_and_copies(docs_of):
    r = random.Random(6)
    prose = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    p = prose(260)
    texts = [prose(r.randint(10, 90)) + p + prose(r.randint(10, 90)) for _ in range(150)] + [prose(300)] * 150
    want = brute(texts, 200)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in op.digest(docs_of(texts), bucket=20).collect()}
    assert got == want


def test_rows_columns_and_text(docs_of):
    p = "é" * 10 + "repeat this " * 30
    d = docs_of(["ü" + p + "tail", "head " + p, None, "", "é" * 150, "one é" * 10]).withColumn("sig", F.lit("x")).withColumn("spans", F.lit(1))
    got = {r.doc_id: r for r in op.remove_repeats(d).collect()}
    assert got[0].text == "ütail" and got[1].text == "head " and got[2].text is None and got[3].text == "" and got[5].text == "one é" * 10
    assert op.remove_repeats(d).columns == d.columns
    assert op.digest(d.limit(0)).count() == 0
    twice = op.digest(d.union(d).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(twice) == 12 and all(r.n_removed == r.n_bytes for r in twice if r.n_bytes >= 200)


def occurrences(texts, part):
    return {(sig, i) for sig, t in texts.items() for i in range(len(t)) if t.startswith(part, i)}


@pytest.mark.parametrize("bucket", [4000, 2])
def test_repeat_groups_hold_all_members_of_classes(docs_of, bucket):
    r = random.Random(15)
    prose = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    p, right = prose(300), [prose(120), prose(120), prose(120)]
    docs = docs_of([prose(20) + p + x + prose(10) for x, n in zip(right, (9, 5, 1)) for _ in range(n)] + [prose(200), p + "--" + p])
    texts = {x._sig: x._text.encode() for x in op._signed(docs).collect()}
    groups = {}
    for x in op.repeat_groups(docs, 50, bucket).collect():
        groups.setdefault((x.repeat, x.length), set()).add((x.sig, x.start))
    assert max(map(len, groups.values())) == 17  # p is in 9 + 5 + 1 texts, and twice in one
    for (_, n), places in groups.items():
        sig, start = min(places)
        part = texts[sig][start:start + n]
        assert n >= 50 and places == occurrences(texts, part)
