"""The runnable jobs end to end: drop folder -> star schema -> dashboard,
and one extrapolation cycle on a snapshot table."""

import json
import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from flightlake import jobs
from flightlake.operators import snapshots
from flightlake.operators.parse import snapshot_split
from flightlake.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
COMMON = ["--shuffle-partitions", "4"]


def test_flight_stream_then_dashboard(spark, scratch):
    inbox, wh = os.path.join(scratch, "inbox"), os.path.join(scratch, "wh")
    fx.flight_state_messages(spark, SF).select("value").write.text(inbox)
    jobs.main(COMMON + ["flight-stream", "--inbox", inbox, "--warehouse", wh,
                        "--checkpoint", os.path.join(scratch, "ckpt"), "--available-now"])
    out = os.path.join(scratch, "q5")
    jobs.main(COMMON + ["dashboard", "q5", "--warehouse", wh, "--lo", "2024-01-05 00:00:00",
                        "--hi", "2024-01-20 12:00:00", "--output", out])
    top = spark.read.parquet(out).collect()
    assert 0 < len(top) <= 10
    jobs.main(COMMON + ["dashboard", "q1", "--warehouse", wh, "--rows", "5"])
    recent = os.path.join(scratch, "recent")
    jobs.main(COMMON + ["dashboard", "q3", "--warehouse", wh, "--last-minutes", "15",
                        "--output", recent])
    assert spark.read.parquet(recent).count() == 0  # the fixture lies in 2024


def test_extrapolate_job(spark, scratch):
    path = os.path.join(scratch, "snaps")
    state = ["ab", "CS", "FR", 1, 1, 2.0, 1.0, 10.0, False, 5.0, 90.0, 0.0, None, 20.0, "7000",
             False, 0]
    for i, lon in enumerate([2.0, 2.5]):
        s = list(state)
        s[5] = lon
        doc = json.dumps({"time": 100 + i, "states": [s]})
        snapshots.write_snapshot(snapshot_split(spark.createDataFrame([Row(value=doc)])), path)
    out = os.path.join(scratch, "generated")
    jobs.main(COMMON + ["extrapolate", "--snapshots", path, "--output", out, "--job-time", "500"])
    jobs.main(COMMON + ["extrapolate", "--snapshots", path, "--output", out, "--job-time", "530",
                        "--steps", "2"])
    got = {r.time: json.loads(r.j)[5]
           for r in spark.read.parquet(out).select("time", F.to_json("state").alias("j")).collect()}
    assert got == {500: 3.0, 530: 4.0}  # the real pair (2.0, 2.5) is read both times
    assert snapshots.latest_two(spark, path)[1].first().time == 101


def test_sql_views_match_functions(spark, scratch):
    from flightlake.operators import enrich, parse, route
    from flightlake.plans import airfields as air
    from flightlake.plans import dashboard as dash
    from flightlake.plans import star_load
    from flightlake.plans.catalog import register_views

    wh, tables = os.path.join(scratch, "wh"), os.path.join(scratch, "tables")
    star_load.load_star_batch(parse.flight_state_parse(fx.flight_state_messages(spark, SF)),
                              0, wh)
    route.write_routed(enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, SF))),
                       tables, batch_id=0)
    names = register_views(spark, wh, tables)
    assert "fait_etat_vol" in names and "airfields" in names and len(names) == 14
    lo, hi = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
    sql = spark.sql(f"""
        SELECT fk_pays, COUNT(DISTINCT fk_aeronef) AS nb_aeronefs
        FROM fait_etat_vol
        WHERE fk_temps BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}'
        GROUP BY fk_pays ORDER BY nb_aeronefs DESC, fk_pays LIMIT 10""")
    star = star_load.read_star(spark, wh)
    assert sql.collect() == dash.top_countries(star["fait_etat_vol"], lo, hi).collect()
    avg = spark.sql("SELECT AVG(geo_score) AS avg FROM hotspots").first()[0]
    assert avg == air.hotspot_geo_score(route.read_routed(spark, tables, "hotspots")).first()[0]
