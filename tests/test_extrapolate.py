"""Snapshot extrapolation rules a-g (FIXTURES.md §3)."""

import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from flightlake.operators import extrapolate, parse, snapshots
from flightlake.sources.streams import read_snapshots

T = 1_700_000_000


def _row(**kw):
    """A 17-value state with defaults, overridden by index: ``i5=2.0``."""
    r = ["ab", "CS1", "FR", 100, 100, 1.0, 1.0, 10.0, False, 5.0, 90.0, 0.0, None,
         20.0, "7000", False, 0]
    for k, v in kw.items():
        r[int(k[1:])] = v
    return r


def _snap(spark, states, time=1):
    doc = json.dumps({"time": time, "states": states})
    return parse.snapshot_split(spark.createDataFrame([Row(value=doc)]))


def _run(spark, prev, curr, **kw):
    p = _snap(spark, prev) if prev is not None else None
    out = extrapolate.extrapolate(_snap(spark, curr, 2), p, T, **kw)
    rows = out.select("pos", "time", F.to_json("state").alias("j")).orderBy("pos").collect()
    return [(r.time, json.loads(r.j)) for r in rows]


def test_numeric_string_null_times(spark):
    (t, s), = _run(spark, [_row(i5=2.0, i7=None, i1="A")], [_row(i5=2.5, i7=1000.0, i1="B")])
    assert t == T
    assert s[5] == 3.0 and s[7] == 1000.0 and s[1] == "B"
    assert s[3] == T and s[4] == T
    assert s[14] == "7000"  # a string stays a string


def test_booleans_parity_and_fixed(spark):
    (_, took_off), = _run(spark, [_row(i8=True)], [_row(i8=False)])
    assert took_off[8] is True
    (_, landed), = _run(spark, [_row(i8=False)], [_row(i8=True)])
    assert landed[8] is True
    (_, spi), = _run(spark, [_row(i15=False)], [_row(i15=True)])
    assert spi[15] == 2
    (_, fixed), = _run(spark, [_row(i8=True, i15=False)], [_row(i8=False, i15=True)],
                       fix_booleans=True)
    assert fixed[8] is False and fixed[15] is True


def test_index_17_and_missing_previous(spark):
    (_, s), = _run(spark, [_row() + [2]], [_row() + [2]])
    assert s[17] is True
    (_, s), = _run(spark, [_row() + [5]], [_row() + [None]])
    assert s[17] is False
    rows = _run(spark, [_row()], [_row(), _row(i8=None, i5=9.0)])
    assert rows[1][1][5] == 9.0 and rows[1][1][8] is False and rows[1][1][3] == T


def test_shorter_previous_row(spark):
    prev = ["ab", "X", "FR", 1, 1, 2.0]
    (_, s), = _run(spark, [prev], [_row(i5=2.5, i6=7.0)])
    assert s[5] == 3.0 and s[6] == 7.0 and s[3] == T


def test_no_previous_snapshot_unchanged(spark):
    (t, s), = _run(spark, None, [_row(i3=123)])
    assert t == 2 and s[3] == 123


def test_steps_and_integers(spark):
    (_, s), = _run(spark, [_row(i5=2.0, i16=1)], [_row(i5=2.5, i16=3)], steps=3)
    assert s[5] == 6.0
    assert s[16] == 17 and isinstance(s[16], int)  # 3 -> 5 -> 9 -> 17


def test_pairing_by_key(spark):
    prev = [_row(i0="b", i5=1.0), _row(i0="a", i5=10.0)]
    curr = [_row(i0="a", i5=11.0), _row(i0="b", i5=2.0)]
    by_pos = _run(spark, prev, curr)
    by_key = _run(spark, prev, curr, key_index=0)
    assert [s[5] for _, s in by_pos] == [21.0, -6.0]
    assert [s[5] for _, s in by_key] == [12.0, 3.0]


def test_snapshot_table_roundtrip(spark, scratch):
    path = f"{scratch}/snaps"
    assert snapshots.latest_two(spark, path) == (None, None)
    docs = f"{scratch}/docs"
    for i, states in enumerate([[_row(i5=2.0)], [_row(i5=2.5)]]):
        spark.createDataFrame([Row(value=json.dumps({"time": 10 + i, "states": states}))]) \
            .write.text(f"{docs}/d{i}")
        snapshots.write_snapshot(read_snapshots(spark, f"{docs}/d{i}"), path)
    prev, curr = snapshots.latest_two(spark, path)
    out = extrapolate.extrapolate(curr, prev, T).select(F.to_json("state").alias("j")).collect()
    assert json.loads(out[0].j)[5] == 3.0
    assert read_snapshots(spark, f"{scratch}/missing").count() == 0


def test_assign_positions_dense_and_ordered(spark):
    keys = ["a0001", "a0002", "a0100", "b0005", "b0006", "c9999", "a0003"]
    rows = [(g, k) for g in (1, 2) for k in keys] + [(3, "zzzz1")]
    df = spark.createDataFrame(rows, "g int, k string")
    out = snapshots.assign_positions(df, ["g"], "k", prefix_len=2).collect()
    for g in (1, 2, 3):
        got = sorted((r.pos, r.k) for r in out if r.g == g)
        want = list(enumerate(sorted(k for gg, k in rows if gg == g)))
        assert got == want


def test_integer_overflow_becomes_double(spark):
    big = 2 ** 62
    (_, s), = _run(spark, [_row(i16=-big)], [_row(i16=big)])
    assert isinstance(s[16], float) and s[16] == float(3 * big)


FIELDS = [("icao24", "string"), ("callsign", "string"), ("origin_country", "string"), ("time_position", "bigint"),
          ("last_contact", "bigint"), ("longitude", "double"), ("latitude", "double"), ("baro_altitude", "double"),
          ("on_ground", "boolean"), ("velocity", "double"), ("true_track", "double"), ("vertical_rate", "double"),
          ("sensors", "array<int>"), ("geo_altitude", "double"), ("squawk", "string"), ("spi", "boolean"),
          ("position_source", "bigint")]
RESULT = [(n, "bigint" if n == "spi" else t) for n, t in FIELDS]


def _many(seed, n=40):
    import random
    r = random.Random(seed)
    some = lambda *v: r.choice([None, *v])
    return [_row(i0=f"a{i}", i5=some(1.5, -2.25, 0.0), i6=some(4.0, 8.5), i7=some(100.0), i8=some(True, False), i15=some(True, False),
                 i16=some(0, 3, 7), i9=some(1.0, 64.0), i12=some([1, 2])) for i in range(n)]


def test_named_extrapolation_equals_the_general_one(spark):
    prev, curr = _many(1, 30), _many(2)
    for steps in (1, 2, 5):
        for key, index in ((None, None), ("icao24", 0)):
            general = extrapolate.extrapolate(_snap(spark, curr, 2), _snap(spark, prev), T, steps=steps, key_index=index)
            want = parse.positional_to_named(general, RESULT, convert=True)
            typed = lambda s, t: parse.positional_to_named(_snap(spark, s, t), FIELDS)
            got = extrapolate.extrapolate_named(typed(curr, 2), typed(prev, 1), T, FIELDS, key=key, steps=steps)
            assert got.columns == want.columns
            # Halves and quarters: sums are exact, in steps or at once.
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), (steps, key)


def test_named_extrapolation_edges(spark):
    typed = lambda s, t: parse.positional_to_named(_snap(spark, s, t), FIELDS)
    curr, prev = [_row(i16=2 ** 62, i8=False), _row(i15=True, i8=True)], [_row(i16=0, i8=True), _row(i15=False, i8=False)]
    one = extrapolate.extrapolate_named(typed(curr, 2), typed(prev, 1), T, FIELDS, fix_booleans=True).orderBy("pos").collect()
    assert one[0].position_source is None and one[0].on_ground is False and one[1].spi is True  # past BIGINT; kept
    far = extrapolate.extrapolate_named(typed(curr, 2), typed(curr, 1), T, FIELDS, steps=100).orderBy("pos").collect()
    assert far[0].position_source == 2 ** 62 and far[0].longitude == 1.0
    assert extrapolate.extrapolate_named(typed(curr, 2), None, T, FIELDS).first().time == 2
    for steps in (0, 1001):
        try:
            extrapolate.extrapolate_named(typed(curr, 2), typed(prev, 1), T, FIELDS, steps=steps)
            raise AssertionError(steps)
        except ValueError:
            pass


def test_steps_cost_one_expression(spark):
    typed = lambda s, t: parse.positional_to_named(_snap(spark, s, t), FIELDS)
    size = lambda n: len(extrapolate.extrapolate_named(typed([_row()], 2), typed([_row()], 1), T, FIELDS, steps=n)
                         ._jdf.queryExecution().optimizedPlan().toString())
    assert size(16) < 1.2 * size(2)


def test_pages_are_read_in_the_order_of_their_numbers(spark, scratch):
    path = f"{scratch}/snaps"
    rows = lambda t, names: _snap(spark, [_row(i0=n) for n in names], t)
    day = 1_704_100_000
    pages = {"2024-01-01T00-page2": (2, ["c", "d"]), "2024-01-01T00-page10": (10, ["e"]), "2024-01-01T00-page1": (1, ["a", "b"]),
             "01": (11, ["f"]), "1": (12, ["g"])}
    for name, (no, names) in pages.items():
        snapshots.write_snapshot(rows(day, names), path, page=name, page_no=no)
    snapshots.write_snapshot(rows(day - 90_000, ["z"]), path)
    snapshots.write_snapshot(rows(day, ["A", "B"]), path, page="2024-01-01T00-page1", page_no=1, load_id="again")
    snapshots.write_snapshot(rows(day, ["A", "b"]), path, page="2024-01-01T00-page1", page_no=1, load_id="again")
    previous, current = snapshots.latest_two(spark, path)
    names = lambda df: [r.n for r in df.select("pos", F.try_variant_get(F.get("state", 0), "$", "string").alias("n")).orderBy("pos").collect()]
    assert names(current) == ["A", "b", "c", "d", "e", "f", "g"] and names(previous) == ["z"]
    assert [r.pos for r in current.orderBy("pos").collect()] == list(range(7))


def test_whole_documents_in_pieces(spark):
    states = [_row(i0=f"a{i}", i14="7000", i16=i) for i in range(7)]
    docs = extrapolate.to_documents(_snap(spark, states, 5), page_size=3).orderBy("page_no").collect()
    assert [r.page_no for r in docs] == [0, 1, 2]
    back = [json.loads(r.value) for r in docs]
    assert all(d["time"] == 5 for d in back) and [s for d in back for s in d["states"]] == states


def test_steps_at_once_equal_steps_one_by_one(spark):
    import random

    r = random.Random(7)
    values = [0, 1, 2, 3, -5, 2.5, 1.0, True, False, None, "", "x", "7", 2**62, -2**63, 2**63 - 1, 10**25, 123456789012345678901.5, [], [1], {}, {"a": 1}]
    rows = lambda: [[r.choice(values) for _ in range(r.randrange(16, 20))] for _ in range(60)]
    prev, curr = _snap(spark, rows()), _snap(spark, rows()[:58] + [_row(i8=1)] * 4, 2)
    shown = lambda df: [(x.pos, x.j) for x in df.select("pos", F.to_json("state").alias("j")).orderBy("pos").collect()]
    for fix in (False, True):
        one = curr
        for n in range(1, 5):
            one = spark.createDataFrame(extrapolate.extrapolate(one, prev, T, fix_booleans=fix).collect(), curr.schema)
            assert shown(extrapolate.extrapolate(curr, prev, T, steps=n, fix_booleans=fix)) == shown(one)


def test_types_are_looked_up_once_whatever_the_steps(spark):
    out = extrapolate.extrapolate(_snap(spark, [_row()], 2), _snap(spark, [_row()]), T, steps=3)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("schema_of_variant") and plan.index("schema_of_variant") < plan.index("aggregate(")
