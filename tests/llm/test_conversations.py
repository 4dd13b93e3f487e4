import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from flightlake.llm import conversations as op
from flightlake.llm.common import table
from tests.conftest import SF001

SPACE = " \t\n\x0b\x0c\r"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def best_edits(rows, faults):
    """All edit strings by brute force: inserts of up to two before each row."""
    found = []

    def walk(i, out, letters, cost):
        if found and cost > found[0][0]:
            return
        if i == len(rows):
            for more in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
                end = out + [(r, "") for r in more]
                if legal("".join(r[:1] if r else "?" for r, _ in end)):
                    found.append((cost + 3 * len(more), letters + "I" * len(more), end))
                    found.sort(key=lambda f: f[:2])
                    del found[1:]
            return
        role, text = rows[i]
        for more in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
            o, s, c = out + [(r, "") for r in more], letters + "I" * len(more), cost + 3 * len(more)
            walk(i + 1, o, s + "D", c + 4)
            if faults[i] not in ("blank", "duplicate"):
                c += 3 * (faults[i] == "truncated")
                walk(i + 1, o + [(role, text)], s + "K", c)
                for r in ("user", "assistant"):
                    walk(i + 1, o + [(r, text)], s + "R", c + 3)

    walk(0, [], "", 0)
    return found[0]


def brute(rows):
    """Expected summaries of damaged rows, by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = []
        for i, (_, role, text) in enumerate(own):
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in [x[1:] for x in own[:i]]
                          else None if end[-1] in ".!?" else "truncated")
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, repaired = best_edits([r[1:] for r in own], faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha)
    return out


def made(seed, n, longest=5):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "uhu"]
    texts = ["Yes.", "No!", "Yes.", "open end", "", " \n", None, "Why?  ", "é."]
    rows = []
    for conv in [None, *range(n)]:
        for k in range(r.randrange(1, longest + 1)):
            rows.append((conv, r.choice([k, k, k, 2 * k, None, 1]), r.choice(roles), r.choice(texts)))
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def got(df):
    rows = df.select(*NAMES).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("sizes", [{}, {"giant": 2, "block": 1}, {"giant": 1, "block": 3}, {"giant_chars": 6, "block": 2}])
def test_summaries_equal_brute_force(spark, sizes):
    rows = made(1, 60)
    expected = brute(damage(rows))
    empty = hashlib.sha256(b"").hexdigest()
    for conv in {r[0] for r in rows} - set(expected):
        expected[conv] = (0, 0, 0, 0, 0, 0, "", empty)
    df = frame(spark, rows).withColumn("at", F.lit("x")).withColumn("nth", F.lit(0)).withColumn("absent", F.lit(True))
    assert got(op.summary(op.damaged(df), absent="absent", **sizes)) == expected


def test_all_short_role_sequences():
    """The dynamic program against all edits, on every row kind up to length four."""
    kinds = [(r, t) for r in ("system", "user", "assistant", "x") for t in ("ok.", "cut")]
    r = random.Random(2)
    every = [s for n in range(1, 4) for s in itertools.product(kinds, repeat=n)] + [tuple(r.choices(kinds, k=5)) for _ in range(60)]
    for rows in every:
        rows = [(role, f"{i}{text}") for i, (role, text) in enumerate(rows)]
        faults = [op.fault_of(t, 1) for _, t in rows]
        path = op.Path()
        for (role, _), f in zip(rows, faults):
            path.add(role[:1], f)
        state, tail = path.end()
        moves, start = op.trace(path.pointers, state)
        assert start == 0
        cost, audit, _ = best_edits(rows, faults)
        assert "".join(op._MOVES[m] for m in moves) + "I" * tail == audit, rows
        assert path.cost[state] + 3 * tail == cost


def test_giant_conversation_equals_a_held_one(spark):
    r = random.Random(4)
    roles, ends = ["user", "assistant", "tool", "system"], [".", "", "!"]
    rows = [(i % 3 and 7, i * 2 + i % 5, r.choice(roles), f"{r.randrange(900)} words{r.choice(ends)}") for i in range(3000)]
    df = frame(spark, rows)
    whole = got(op.summary(df))
    assert whole == got(op.summary(df, giant=100, block=128))
    edits = [op.repair(df, **s).orderBy("conv_id", "step").collect() for s in ({}, {"giant": 100, "block": 128})]
    assert edits[0] == edits[1] and {e.edit for e in edits[0]} == set("KRDI")
    assert sum(e.edit != "I" for e in edits[0]) == len(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (1, 4, "assistant", "So it"), (2, None, None, None)]
    out = [tuple(r) for r in op.repair(frame(spark, rows)).orderBy("conv_id", "step").collect()]
    assert out == [(1, 0, "K", 0, "user", "Hi.", "user", None), (1, 1, "D", 1, "user", "Hi.", "user", "duplicate"),
                   (1, 2, "I", None, "assistant", "", None, None), (1, 3, "K", 2, "user", "Well?", "user", None),
                   (1, 4, "K", 4, "assistant", "So it", "assistant", "truncated"), (2, 0, "D", None, " ", " ", " ", "blank")]


def test_odd_tables(spark):
    assert op.summary(frame(spark, [])).collect() == []
    long = "words and " * 200_000
    rows = [(2 ** 62, 2 ** 62, "user", long + "."), (2 ** 62, 2 ** 62 + 1, "assistant", long), (2 ** 62 + 1, -2 ** 63, "user", "a."),
            (2 ** 62 + 1, 2 ** 63 - 1, "user", "b.")]
    result = got(op.summary(frame(spark, rows)))
    assert result[2 ** 62] == brute(rows)[2 ** 62] and len(result) == 2
    named = spark.createDataFrame([("x", 1, "user", "Yes."), (None, 2, "user", "Yes.")], "conv_id string, turn int, role string, text string")
    assert set(got(op.summary(named))) == {"x", None}


def test_query_on_the_test_tables(spark):
    from flightlake.llm.queries import queries

    rows = [tuple(r) for r in table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    result = got(queries()["op11_conversation_repair"](spark, SF001))
    assert set(result) == {r[0] for r in rows}
    expected = brute(damage([r for r in rows if r[0] is not None and r[0] < 40]))
    assert all(result[c] == e for c, e in expected.items()) and expected
