"""Folds (K2, K3, K5): reads equal a model over any sequence of loads, replays,
folds and folds killed half-way; files follow the size, not the batches."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flightlake.operators import folds, upsert
from flightlake.plans import star_load

SCHEMA = StructType([StructField("k", StringType()), StructField("v", LongType())])


def put(spark, path, stream, batch, rows):
    upsert.append_batch(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, stream, batch)


def fold(spark, path):
    return folds.fold(spark, path, SCHEMA, lambda rows: upsert.latest_rows(rows, "k"))


def table(spark, path):
    return {r.k: r.v for r in upsert.read_table(spark, path, SCHEMA, "k").collect()}


class Killed(Exception):
    pass


def dies(*_):
    raise Killed


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_reads_like_a_dict(spark, scratch, monkeypatch, seed):
    r = random.Random(seed)
    path, model, batches, last = f"{scratch}/t", {}, {"a": 0, "b": 0}, None
    for _ in range(26):
        step = r.choice(["load", "load", "load", "replay", "fold", "killed rows", "killed marks", "killed clean"])
        if step == "load":
            s = r.choice("ab")
            rows = [(f"k{r.randrange(12)}", r.randrange(1000)) for _ in range(3)]
            rows = list(dict(rows).items())
            put(spark, path, s, batches[s], rows)
            last, batches[s] = (s, batches[s], rows), batches[s] + 1
            model.update(rows)
        elif step == "replay" and last:
            put(spark, path, *last)
            model.update(last[2])
        elif step == "fold" and last:
            fold(spark, path)
        elif last and step.startswith("killed"):
            with monkeypatch.context() as m:
                m.setattr(folds, {"killed rows": "marks", "killed marks": "_put_marks", "killed clean": "_clean"}[step], dies)
                try:
                    fold(spark, path)
                except Killed:
                    pass
        if last:
            assert table(spark, path) == model, step
    fold(spark, path)
    assert table(spark, path) == model


def test_reading_after_many_batches_costs_what_it_does_after_few(spark, scratch):
    path = f"{scratch}/t"
    counts = []
    for n in range(40):
        put(spark, path, "s", n, [(f"k{n % 7}", n), ("all", n)])
        if n in (9, 10, 11, 37, 38):
            fold(spark, path)
        if n in (11, 39):
            counts.append(len(folds.read_folded(spark, path, SCHEMA).inputFiles()))
    assert table(spark, path) == {**{f"k{i}": max(n for n in range(40) if n % 7 == i) for i in range(7)}, "all": 39}
    # One file of the fold (or a few), and those of the batches after it.
    assert counts[1] <= counts[0] + 2 <= 8, counts


def test_a_fold_beside_a_running_stream(spark, scratch):
    """A stream appends while folds and reads go on: no read sees less than the
    one before it, or any row twice."""
    path, n, seen, failed = f"{scratch}/t", 25, [], []

    def stream():
        try:
            for i in range(n):
                put(spark, path, "s", i, [(f"k{i}", i)])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    put(spark, path, "s0", 0, [("first", 0)])
    t = threading.Thread(target=stream)
    t.start()
    while t.is_alive():
        fold(spark, path)
        keys = [r.k for r in folds.read_folded(spark, path, SCHEMA).collect()]
        assert len(keys) == len(set(keys))
        assert not seen or seen[-1] <= set(keys)
        seen.append(set(keys))
    t.join()
    assert not failed and len(seen) > 1
    assert table(spark, path) == {"first": 0} | {f"k{i}": i for i in range(n)}


def states(spark, rows):
    """Mapped states ``(icao, time, lat, velocity)``."""
    nulls = {"callsign": "string", "baro_altitude": "double", "geo_altitude": "double", "vertical_rate": "double",
             "true_track": "double", "spi": "boolean", "position_source": "string", "squawk": "string", "category": "double"}
    df = spark.createDataFrame(rows, "icao24 string, time_position timestamp, latitude double, velocity double")
    return df.withColumns({"origin_country": F.lit("FR"), "longitude": F.lit(2.5), "on_ground": F.lit(False),
                           "last_contact": F.col("time_position"), **{c: F.lit(None).cast(t) for c, t in nulls.items()}})


def at(day, second=0):
    return dt.datetime(2024, 1, day, 12, 0, second, tzinfo=dt.timezone.utc)


def test_closed_days(spark, scratch):
    wh = f"{scratch}/wh"
    total, files = 0, []
    for n in range(12):  # every batch has rows of four days, one of them late
        rows = [(f"a{n}", at(d, n), 45.0 + n, float(n)) for d in (1, 2, 3, 4)]
        star_load.load_star_batch(states(spark, rows), n, wh)
        total += 4
        if n in (5, 6, 9, 10):
            star_load.close_days(spark, wh, "2024-01-04")
            star_load.fold_dimensions(spark, wh)
            star_load.close_days(spark, wh, "2024-01-04")  # nothing new
        if n in (6, 10):
            fact = star_load.read_star(spark, wh)[star_load.FACT]
            assert fact.count() == total
            files.append(len([f for f in fact.filter("day < date'2024-01-04'").inputFiles() if "__folds/" in f]))
    fact, dims, times = star_load.dashboard_tables(spark, wh)
    got = {(r.fk_aeronef, r.fk_temps.day) for r in fact.collect()}
    assert fact.count() == len(got) == total == 48 and dims is None
    assert {r.fk_temps for r in times.collect()} == {r.fk_temps for r in fact.select("fk_temps").collect()}
    assert files[0] == files[1], files
    # A day outside the range is not listed: the predicate is on the folders of both parts.
    one = fact.filter("day = date'2024-01-02'")
    assert one.count() == 12
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("day#") and plan.count("PartitionFilters: [isnotnull(day#") + plan.count("PartitionFilters: [isnotnull(fold#") >= 1
    t = star_load.read_star(spark, wh)
    assert t["dim_position"].count() == 12 and t["dim_aeronef"].count() == 12


def test_old_warehouse_keeps_its_joins(spark, scratch):
    """Without the record of held keys the dimensions are joined, and the last
    reading comes from the fact."""
    wh = f"{scratch}/wh"
    rows = states(spark, [("a", at(1), 45.0, 1.0)])
    upsert.append_batch(rows.select(F.lit("FR").alias("pk_pays"), F.lit("FR").alias("nom_pays")), f"{wh}/dim_pays", "old", 0)
    star_load.load_star_batch(rows, 1, wh, "old")
    fact, dims, times = star_load.dashboard_tables(spark, wh)
    assert fact.count() == 1 and len(dims) == 3 and times is None


def test_compaction_takes_folds_along(spark, scratch):
    wh = f"{scratch}/wh"
    for n in range(3):
        star_load.load_star_batch(states(spark, [(f"a{n}", at(n + 1), 45.0, float(n))]), n, wh)
    star_load.fold_dimensions(spark, wh)
    star_load.close_days(spark, wh, "2024-01-03")
    star_load.compact(spark, wh, f"{scratch}/to")
    a, b = star_load.read_star(spark, wh), star_load.read_star(spark, f"{scratch}/to")
    for name in a:
        rows = lambda t: sorted(map(str, t[name].collect()))  # noqa: B023, E731
        assert rows(a) == rows(b) and (rows(a) or name == "dim_vol")
    assert star_load.dashboard_tables(spark, f"{scratch}/to")[1] is None
