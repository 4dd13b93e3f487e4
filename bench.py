"""Benchmark: ingest + dashboard queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Steps, each timed:
  load_star     D7 parse + D1-D6 star load of all flight-state messages (one batch)
  load_airports D8 parse + D9 enrich + D10 routed write of all envelopes
  load_fold     dimensions folded and days closed after a second batch
  q1..q12       dashboard queries over the stored tables (warm, median of 3)
  r1            snapshot extrapolation of every stored hourly snapshot against
                the hour before, over typed columns (snapshots written once,
                ``load_snapshots``); load_r1_steps16 and load_r1_general beside it: 16
                steps, and the same job over arrays of variants

Prints one JSON line; ``value`` is the sum of the query medians (q1-q12, r1).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks.oracle_sql import HI, LO  # noqa: E402
from flightlake.operators import enrich, extrapolate, parse, route, snapshots  # noqa: E402
from flightlake.plans import airfields as air  # noqa: E402
from flightlake.plans import dashboard as dash  # noqa: E402
from flightlake.plans import star_load  # noqa: E402
from flightlake.schemas import SNAPSHOT_FIELDS  # noqa: E402
from flightlake.session import checkpoint_root, get_session  # noqa: E402
from flightlake.sources import fixtures as fx  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(fn, reps: int = 3) -> float:
    fn()  # warm-up
    times = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "8g"})
    # Shared folder named by the cluster (a fresh local one only when unset).
    work = f"{checkpoint_root(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    wh, tables = f"{work}/warehouse", f"{work}/airports"

    timings: dict[str, float] = {}
    n_msgs = fx.flight_state_messages(spark, sf).count()
    runs = iter(range(100))

    def load_star(target=None):
        target = target or f"{work}/wh-{next(runs)}"
        msgs = fx.flight_state_messages(spark, sf)
        star_load.load_star_batch(parse.flight_state_parse(msgs), 0, target)

    def load_airports(target=None):
        target = target or f"{work}/air-{next(runs)}"
        rows = enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, sf)))
        route.write_routed(rows, target, batch_id=0)

    # Ingest timed like the queries: warm, median of 3, each into a fresh folder.
    timings["load_star"] = _median(load_star)

    def second_batch():
        msgs = fx.flight_state_messages(spark, sf).limit(500)
        star_load.load_star_batch(parse.flight_state_parse(msgs), next(runs) + 1, f"{work}/wh-0")

    # A small batch into tables that hold everything: the cost of a batch, not of the table.
    timings["load_star_second"] = _median(second_batch)
    timings["load_airports"] = _median(load_airports)
    load_star(wh)
    load_airports(tables)

    def fold():
        target = f"{work}/wh-{next(runs)}"
        states = parse.flight_state_parse(fx.flight_state_messages(spark, sf).limit(20_000))
        for i in range(2):
            star_load.load_star_batch(states, i, target)
        t0 = time.perf_counter()
        star_load.fold_dimensions(spark, target)
        star_load.close_days(spark, target, "2024-01-20")
        return time.perf_counter() - t0

    timings["load_fold"] = statistics.median(fold() for _ in range(2))
    pays = star_load.read_star(spark, wh)["dim_pays"]
    fact, dims, times = star_load.dashboard_tables(spark, wh)
    lo, hi = LO, HI
    airfields = route.read_routed(spark, tables, "airfields")
    hotspots = route.read_routed(spark, tables, "hotspots")
    airports = route.read_routed(spark, tables, "airports")
    # Snapshots stored once (K9 layout: one partition per snapshot hour); R1
    # reads them back like a scheduled job would.
    t0 = time.perf_counter()
    snapshots.write_snapshot(fx.snapshot_rows(spark, sf), f"{work}/snapshots", time_col="snap")
    timings["load_snapshots"] = time.perf_counter() - t0
    later = lambda df: df.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    snaps = spark.read.parquet(f"{work}/snapshots")
    snapshots.write_snapshot(fx.snapshot_states(spark, sf), f"{work}/variants", time_col="snap")
    variants = spark.read.parquet(f"{work}/variants")
    job_time = F.unix_seconds(F.col("snap").cast("timestamp")) + F.lit(30)

    queries = {
        "q1": lambda: dash.fleet_status(fact, lo, hi, times),
        "q2": lambda: dash.live_map(fact, *(dims or (None,) * 3), lo=lo, hi=hi),
        "q3": lambda: dash.status_over_time(fact, dims, lo, hi),
        "q4": lambda: dash.share_of_total(dash.status_split(fact, lo, hi, times), "nb_avions"),
        "q5": lambda: dash.top_countries(fact, lo, hi),
        "q6": lambda: dash.vertical_over_time(fact, dims, lo, hi),
        "q7": lambda: dash.altitude_bands(fact, lo, hi, times=times),
        "q8": lambda: dash.country_options(pays),
        "q9": lambda: air.airfield_preview(airfields),
        "q10": lambda: air.hotspot_geo_score(hotspots),
        "q11": lambda: air.airfield_table(airfields),
        "q12": lambda: air.country_altitude(airports),
        "r1": lambda: extrapolate.extrapolate_named(snaps, later(snaps), job_time, SNAPSHOT_FIELDS[:17], by=["snap"]),
        "load_r1_steps16": lambda: extrapolate.extrapolate_named(snaps, later(snaps), job_time, SNAPSHOT_FIELDS[:17], by=["snap"], steps=16),
        "load_r1_general": lambda: extrapolate.extrapolate(variants, later(variants), job_time, by=["snap"]),
    }
    for name, build in queries.items():
        timings[name] = _median(lambda b=build: _run(b()))
    total = sum(v for k, v in timings.items() if not k.startswith("load"))
    print(json.dumps({
        "metric": "dashboard_queries_total_median_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": os.path.basename(sf.rstrip("/")),
        "cpus": int(cpus),
        "rows_ingested_per_sec": round(n_msgs / timings["load_star"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
