"""Summarise the physical plans of the bench queries over stored tables.

    python -m checks.plans [sf_dir] [--no-broadcast]

``--no-broadcast`` turns size-based broadcasts off (static and AQE) to show
the shape the plans take when dimensions outgrow the broadcast threshold.

Per query: shuffles (Exchange), join strategies, partial window limits,
top-k, and whether filters reach the scan. Used to keep the README's plan
table honest.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
import uuid

from pyspark.sql import functions as F


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summary(text: str) -> dict:
    head = text.split("\n\n")[0]
    ops = re.findall(r"[+-]- ([A-Za-z]+(?: [A-Za-z]+)*) \(\d+\)", head)
    ops += re.findall(r"^([A-Za-z]+(?: [A-Za-z]+)*) \(\d+\)", head, re.M)
    joins = sorted({o for o in ops if "Join" in o})
    return {
        "exchanges": sum(1 for o in ops if o == "Exchange"),
        "joins": ", ".join(joins) or "-",
        "partial_limit": "WindowGroupLimit" in text and "Partial" in text,
        "top_k": "TakeOrderedAndProject" in text,
        "pushed": bool(re.search(r"PushedFilters: \[[^\]]+\]", text)),
        "partition_filters": bool(re.search(r"PartitionFilters: \[[^\]]+\]", text)),
    }


def main(argv) -> None:
    no_bc = "--no-broadcast" in argv
    argv = [a for a in argv if a != "--no-broadcast"]
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    from checks.oracle_sql import HI, LO
    from flightlake.operators import enrich, extrapolate, parse, route, snapshots
    from flightlake.plans import airfields as air
    from flightlake.plans import dashboard as dash
    from flightlake.plans import star_load
    from flightlake.session import checkpoint_root, get_session
    from flightlake.sources import fixtures as fx

    spark = get_session("local[8]", 8)
    if no_bc:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    work = f"{checkpoint_root(spark).rstrip('/')}/plans-{uuid.uuid4().hex[:8]}"
    star_load.load_star_batch(parse.flight_state_parse(fx.flight_state_messages(spark, sf)),
                              0, f"{work}/wh")
    route.write_routed(enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, sf))),
                       f"{work}/air", batch_id=0)
    snapshots.write_snapshot(fx.snapshot_states(spark, sf), f"{work}/snaps", time_col="snap")
    t = star_load.read_star(spark, f"{work}/wh")
    fact, dims = t["fait_etat_vol"], (t["dim_aeronef"], t["dim_position"], t["dim_pays"])
    snaps = spark.read.parquet(f"{work}/snaps")
    prev = snaps.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    rt = lambda n: route.read_routed(spark, f"{work}/air", n)
    queries = {
        "q1 fleet_status": dash.fleet_status(fact, LO, HI),
        "q2 live_map": dash.live_map(fact, *dims, lo=LO, hi=HI),
        "q3 status_over_time": dash.status_over_time(fact, dims, LO, HI),
        "q4 status_share": dash.share_of_total(dash.status_split(fact, LO, HI), "nb_avions"),
        "q5 top_countries": dash.top_countries(fact, LO, HI),
        "q6 vertical_over_time": dash.vertical_over_time(fact, dims, LO, HI),
        "q7 altitude_bands": dash.altitude_bands(fact, LO, HI),
        "q8 country_options": dash.country_options(t["dim_pays"]),
        "q9 airfield_preview": air.airfield_preview(rt("airfields")),
        "q10 hotspot_geo_score": air.hotspot_geo_score(rt("hotspots")),
        "q12 country_altitude": air.country_altitude(rt("airports")),
        "r1 extrapolate": extrapolate.extrapolate(snaps, prev, 0, by=["snap"]),
        "d5 dim_position (batch)": __import__("flightlake.operators.star", fromlist=["x"])
        .dim_position(fx.flight_states(spark, sf)),
    }
    print("| query | exchanges | joins | partial limit | top-k | pushed filters | partition filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, df in queries.items():
        s = summary(plan_text(df))
        yn = lambda b: "yes" if b else "-"
        print(f"| {name} | {s['exchanges']} | {s['joins']} | {yn(s['partial_limit'])} | "
              f"{yn(s['top_k'])} | {yn(s['pushed'])} | {yn(s['partition_filters'])} |")


if __name__ == "__main__":
    main(sys.argv[1:])
