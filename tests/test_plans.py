"""Physical-plan properties the scale design relies on (read from
``explain()``): pushdown and pruning, partial limits before shuffles, top-k
without a full sort, and no Python or cartesian operators anywhere."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E
from checks.oracle_sql import HI, LO
from flightlake.operators import parse, star
from flightlake.plans import airfields as air
from flightlake.plans import dashboard as dash
from flightlake.plans import star_load
from flightlake.sources import fixtures as fx
from tests.conftest import SF001

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    wh = os.path.join(str(tmp_path_factory.mktemp("plans")), "wh")
    star_load.load_star_batch(parse.flight_state_parse(fx.flight_state_messages(spark, SF)),
                              0, wh)
    return star_load.read_star(spark, wh)


def test_last_reading_pushes_scalar_and_prunes_days(stored):
    p = plan(dash.fleet_status(stored["fait_etat_vol"], LO, HI))
    assert "EqualTo(fk_temps,ScalarSubquery" in p
    assert "PartitionFilters: [isnotnull(day" in p and "Subquery" in p
    assert "ReadSchema: struct<fk_temps:timestamp,fk_aeronef:string,geo_altitude:double," in p


def test_time_range_reaches_scan(stored):
    p = plan(dash.top_countries(stored["fait_etat_vol"], LO, HI))
    assert "GreaterThanOrEqual(fk_temps" in p and "LessThanOrEqual(fk_temps" in p
    assert "(day" in p  # partition predicate
    assert "TakeOrderedAndProject" in p
    assert p.count("HashAggregate") >= 4  # distinct count in two phases


def test_latest_per_aircraft_limits_before_shuffle(stored):
    p = plan(dash.live_map(stored["fait_etat_vol"], stored["dim_aeronef"],
                           stored["dim_position"], stored["dim_pays"], LO, HI))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_existence_checks_are_semi_joins(stored):
    dims = (stored["dim_aeronef"], stored["dim_position"], stored["dim_pays"])
    p = plan(dash.status_over_time(stored["fait_etat_vol"], dims, LO, HI))
    assert p.count("LeftSemi") >= 3


def test_dimension_dedup_limits_before_shuffle(spark):
    p = plan(star.dim_position(fx.flight_states(spark, SF)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_preview_is_top_k(spark):
    p = plan(air.airfield_preview(fx.airport_items(spark, SF)))
    assert "TakeOrderedAndProject" in p


BANNED = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
          "FlatMapGroupsInPandas", "MapInPandas"]


#: Queries that write tables and read them back: what is left of their plans is a scan.
WRITERS = {n for n in E._QUERIES if n.endswith(("_stored", "_stream", "_order", "_streams", "_folded", "_back", "_pair"))} | {
    "upsert_stored_batches", "upsert_folded_batches", "fact_closed_days", "fact_stream_restart", "batch_metrics",
    "snapshot_files", "time_range_other_zone"}


@pytest.mark.parametrize("name", sorted(set(E._QUERIES) - WRITERS))
def test_no_python_or_cartesian_operators(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for op in BANNED:
        assert op not in p, (name, op)


def _stored_tables(spark, scratch):
    from flightlake.operators import parse
    from flightlake.plans import star_load
    from flightlake.sources import fixtures as fx

    wh = f"{scratch}/wh"
    star_load.load_star_batch(parse.flight_state_parse(fx.flight_state_messages(spark, SF)), 0, wh)
    return star_load.dashboard_tables(spark, wh)


def test_no_position_shuffle_over_held_keys(spark, scratch):
    """With broadcasts off, Q2, Q3 and Q6 over a warehouse whose keys hold
    join nothing and deal out nothing by position."""
    import re

    from flightlake.plans import dashboard as dash

    fact, dims, _ = _stored_tables(spark, scratch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, exchanges in [(dash.live_map(fact, *(dims or (None,) * 3)), 1),
                              (dash.status_over_time(fact, dims), 2), (dash.vertical_over_time(fact, dims), 2)]:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan
            dealt = re.findall(r"Exchange (?:hash|range)partitioning\(([a-z_]+)", plan)
            assert len(dealt) == exchanges and "fk_position" not in dealt, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_reading_needs_no_fact_scan(spark, scratch):
    """A1 + J4: the maximum is read off the reading times; the fact is scanned
    once, for its rows."""
    from flightlake.plans import dashboard as dash

    fact, _, times = _stored_tables(spark, scratch)
    for query in (dash.fleet_status, dash.status_split, dash.altitude_bands):
        whole = query(fact).collect()
        df = query(fact, times=times)
        assert sorted(map(str, df.collect())) == sorted(map(str, whole))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        scans = [x for x in plan.splitlines() if "Relation [" in x]
        assert sum("velocity#" in x for x in scans) == 1, plan
        assert len(scans) > 1 and all("velocity#" in x or "loaded_at#" in x for x in scans)


def test_batches_of_one_feed_are_parsed_once(spark, monkeypatch):
    plans, load = [], star_load.load_star_batch

    def spy(states, *args, **kw):
        plans.append(states._jdf.queryExecution().withCachedData().toString())
        return load(states, *args, **kw)

    monkeypatch.setattr(star_load, "load_star_batch", spy)
    for query in ("upsert_stored_batches", "upsert_folded_batches"):
        E.queries()[query](spark, SF001)
    assert len(plans) == 8 and all("InMemoryRelation" in p for p in plans)
