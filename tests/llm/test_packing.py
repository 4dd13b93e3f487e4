import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flightlake.llm import packing

PATH = P.path("word_bpe_49k.json")
REAL = Tokenizer.from_file(PATH)
REAL.encode_special_tokens = True


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library(text):
    got = np.frombuffer(packing.word_ids(PATH)(text), "<u4").tolist()
    assert got == REAL.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=30))
def test_plan_uses_every_piece_once(counts):
    runs = packing.plan(counts, 50)
    used = {}
    for n, lengths in runs:
        assert n > 0 and sum(lengths) <= 50
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == counts
    # No two sequences could be merged: best fit opens one only when nothing fits.
    loads = sorted(sum(ls) for n, ls in runs for _ in range(min(n, 2)))
    assert len(loads) < 2 or loads[0] + loads[1] > 50


def test_exact_complements_leave_no_room():
    assert sum(n for n, _ in packing.plan({30: 4, 20: 4}, 50)) == 4
    assert sum(n for n, _ in packing.plan({30: 3, 10: 6}, 50)) == 3
    assert sum(n for n, _ in packing.plan({20: 2, 15: 2, 10: 2, 5: 2}, 50)) == 2


def test_pack(docs_of):
    texts = [None, "", "one", "Straße's ÀÉ 12'3 日本語", "word " * 250, "word " * 99, "a b " * 40] + [f"w{i} " * (i % 37) for i in range(60)]
    texts += texts[4:6]
    d = docs_of(texts).withColumn("length", F.lit("x")).withColumn("rank", F.lit(0))
    rows = packing.pack(d, PATH, capacity=100).collect()
    cut = {}
    for i, t in enumerate(texts):
        ids = REAL.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 100)):
            part = ids[at:at + 100]
            cut[i, k] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == cut and len(rows) == len(cut)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 100
    assert len(sequences) <= -(-sum(x[1] for x in cut.values()) // 100) + 2
    assert packing.pack(d.limit(0), PATH).count() == 0


def test_hot_length_and_repeated_rows(docs_of):
    d = docs_of(["same text"] * 500)
    rows = packing.pack(d.union(d), PATH, capacity=10).collect()
    assert len(rows) == 1000
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000


def test_pieces_of_a_large_vocabulary_are_merged_once():
    ids, merged = packing.WordIds(PATH), []

    class Model:
        def __init__(self, model):
            self.tokenize = lambda piece: merged.append(piece) or model.tokenize(piece)

    ids.model = Model(ids.model)
    letters = [chr(97 + i) for i in range(26)]
    text = " ".join(a + b + c + d for a in letters for b in letters for c in letters for d in letters[:10])
    assert ids(text) == ids(text)
    assert len(merged) == len(set(merged)) == 26 ** 3 * 10
    for t in ("'s'test''re don't WE'LL...'d 'x '", "a'ſ à'és 1'2'll!'m"):
        assert np.frombuffer(ids(t), "<u4").tolist() == REAL.encode(t, add_special_tokens=False).ids
