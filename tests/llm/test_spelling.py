import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_of(texts):
    n = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def variants_of(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows(df):
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", max_size=6), unique=True, max_size=40))
def test_scan_finds_all_pairs_one_edit_apart(words):
    words = sorted(words)
    got = list(spelling.near_pairs(words))
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and one_edit(a, b)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=9), unique=True, max_size=40))
def test_a_pair_counts_in_one_block(words):
    blocks = {}
    for w in words:
        for key, rest in spelling.halves(w):
            blocks.setdefault(key, {})[w] = rest
    got = Counter()
    for key, held in blocks.items():
        for a in held:
            for b in held:
                if a < b and one_edit(held[a], held[b]) and spelling._first_block(spelling._cuts(key), a, b):
                    got[a, b] += 1
    assert got == Counter((a, b) for a in words for b in words if a < b and one_edit(a, b))


def made(seed, n):
    """Words with many near ones: edits of edits of a few stems."""
    import random
    r = random.Random(seed)
    words = ["spelling", "thought", "éclair", "aaaaaa", "streets"]
    while len(words) < n:
        w = r.choice(words)
        at = r.randrange(len(w) + 1)
        w = r.choice([w[:at] + r.choice("aesté") + w[at:], w[:at] + r.choice("aesté") + w[at + 1:], w[:at] + w[at + 1:]])
        if len(w) >= 4:
            words.append(w)
    return {w: r.choice([3, 4, 5, 9, 20, 41, 90, 400]) for w in words}


@pytest.mark.parametrize("block", [spelling.BLOCK, 30, 2])
def test_variants_equal_brute_force(spark, block):
    words = made(1, 700)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows(spelling.group_variants(df, block=block)) == variants_of(words)


def test_whole_operator(spark):
    stems = list(made(2, 60))
    texts = [(i, " ".join(w.title() if (i + k) % 3 else w for k, w in enumerate(stems) if (i * k) % 7 < 4)) for i in range(60)]
    texts += [(60, None), (61, ""), (62, "12 %& \n"), (None, "thought thought thought"), (63, "Straße×Ünder ÀÉÎ " * 5), (0, texts[0][1])]
    df = (spark.createDataFrame(texts, "doc_id long, text string")
          .withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("key", F.lit(0)))
    assert rows(spelling.spelling_variants(df)) == variants_of(words_of(texts))
    assert spelling.spelling_variants(df.limit(0)).collect() == []


def test_long_texts_and_runs_are_counted_whole(monkeypatch):
    text = "abcde, fghij " * 5000 + "x" * 30000 + " end"
    whole = spelling.observed(7, text)
    monkeypatch.setattr(spelling, "_SLICE", 1000)
    assert spelling.observed(7, text) == whole and sum(whole.values()) == 10002


def test_roots_follow_long_ways(spark):
    ways = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(40)] + [(f"v{i:03d}", "w005") for i in range(50)]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(ways, "word string, form string")).collect()))
    assert got == {w: "w040" for w, _ in ways}
