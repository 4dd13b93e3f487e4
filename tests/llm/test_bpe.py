import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REAL = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [None, "", "  a  b \n\n c", "x y  z", "'s it's 'S\x1c a\x85b", "日本語 123abc ́é <|endoftext|>",
         " \n", " " * 50 + "q", "a" * 3000, "\t\tfoo\r\nbar \n baz   ", "the same", "the same"]


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"key{i}".encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert [h.get(k) for k in keys] == list(range(5000))
    assert sorted(h.values) == list(range(5000)) and h.get(b"other") == -1
    assert bpe.PerfectHash([]).get(b"x") == -1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library(text):
    c = bpe.codec(PATH, P.PATTERN)
    assert c.encode(text) == REAL.encode_ordinary(text)
    assert c.decode(c.encode(text)) == text.encode()


def test_round_trip_digest(docs_of):
    texts = TEXTS + ["word " * 60000]
    d = docs_of(texts).withColumn("n_tokens", F.lit("x"))
    got = {r.doc_id: r for r in bpe.round_trip(d, PATH, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = REAL.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(d.limit(0), PATH, P.PATTERN).count() == 0


def test_encode_and_decode_columns(docs_of):
    d = docs_of(TEXTS).withColumn("ids", F.lit(1))
    both = bpe.decode(bpe.encode(d, PATH, P.PATTERN), PATH, P.PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in both.collect())
    assert set(d.columns) <= set(both.columns)


def test_bad_id_raises():
    with pytest.raises(KeyError):
        bpe.codec(PATH, P.PATTERN).decode([10**6])
