"""

``entry(spark)`` runs the flagship query (top countries by distinct aircraft)
on sf0.001. ``queries()`` registers one callable per operator of SURVEY §2,
each built from the library over tables derived from the driver's parquet
(FIXTURES.md); ``oracle_sql()`` gives the DuckDB text for the same result.
"""

from __future__ import annotations

import contextlib
import os
import sys
import warnings
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.oracle_sql import HI, LO  # noqa: E402
from checks.oracle_sql import oracle_sql as _oracle_sql  # noqa: E402
from checks.ordered import with_position  # noqa: E402
from flightlake.operators import (  # noqa: E402
    enrich, extrapolate, filters, parse, route, star, upsert,
)
from flightlake.plans import airfields as air  # noqa: E402
from flightlake.plans import dashboard as dash  # noqa: E402
from flightlake.schemas import SNAPSHOT_FIELDS  # noqa: E402
from flightlake.sources import fixtures as fx  # noqa: E402

try:  # The training-data operators are a separate subpackage, with needs of their own.
    from flightlake.llm import queries as _llm
except ImportError as e:
    warnings.warn(f"training-data queries left out: {e}")
    _llm = None
try:
    import corpus_pipeline as _pipeline
except ImportError as e:
    warnings.warn(f"pipeline left out: {e}")
    _pipeline = None

SF_SMOKE = "/root/testdata/sf0.001"


def _utc(fn):
    """Results are defined in UTC (epochs, dates, weekday names): pin the
    session zone like ``flightlake.get_session`` does."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _utc_wall_clock(df: DataFrame) -> DataFrame:
    """TIMESTAMP (instant) columns as TIMESTAMP_NTZ in UTC, the type of the
    oracle's naive timestamps; the session zone is pinned to UTC."""
    from pyspark.sql.types import TimestampType
    ts = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts}) if ts else df


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return star.star(fx.flight_states(spark, sf))


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    # Float sums depend on addition order: compare averages to 6 places.
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def q_top_countries(spark, sf):
    t = _star(spark, sf)
    return dash.top_countries(t["fait_etat_vol"], LO, HI)


def entry(spark: SparkSession) -> DataFrame:
    return _utc(q_top_countries)(spark, SF_SMOKE)


def q_state_mapping(spark, sf):
    return _utc_wall_clock(parse.flight_state_parse(fx.flight_state_messages(spark, sf)))


def q_state_mapping_binary(spark, sf):
    """The same messages as bytes, as a message queue delivers them."""
    msgs = fx.flight_state_messages(spark, sf).withColumn("value", F.col("value").cast("binary"))
    return _utc_wall_clock(parse.flight_state_parse(msgs))


def q_state_quarantine(spark, sf):
    """Messages a flat-schema parse cannot read, kept with their raw text."""
    return parse.flight_state_quarantine(
        fx.flight_state_messages(spark, sf, with_malformed=True))


def _dim(name):
    return lambda spark, sf: _star(spark, sf)[name]


def q_fleet_status(spark, sf):
    out = dash.fleet_status(_star(spark, sf)["fait_etat_vol"], LO, HI)
    return _r6(out, "Vitesse moyenne (km/h)", "Altitude géo moyenne (m)")


def q_live_map(spark, sf):
    t = _star(spark, sf)
    return dash.live_map(t["fait_etat_vol"], t["dim_aeronef"], t["dim_position"],
                         t["dim_pays"], LO, HI)


def _dims(t):
    return (t["dim_aeronef"], t["dim_position"], t["dim_pays"])


def q_status_over_time(spark, sf):
    t = _star(spark, sf)
    return dash.status_over_time(t["fait_etat_vol"], _dims(t), LO, HI)


def q_status_share(spark, sf):
    t = _star(spark, sf)
    return dash.share_of_total(dash.status_split(t["fait_etat_vol"], LO, HI), "nb_avions")


def q_vertical_over_time(spark, sf):
    t = _star(spark, sf)
    return dash.vertical_over_time(t["fait_etat_vol"], _dims(t), LO, HI)


def q_altitude_bands(spark, sf):
    return dash.altitude_bands(_star(spark, sf)["fait_etat_vol"], LO, HI)


def q_country_options(spark, sf):
    return dash.country_options(_star(spark, sf)["dim_pays"])


def q_status_last_non_null(spark, sf):
    fact = filters.time_range(_star(spark, sf)["fait_etat_vol"], "fk_temps", LO, HI)
    return dash.last_not_null(fact, ["fk_aeronef"], ["geo_altitude", "velocity"],
                              ["fk_temps", "last_contact", "fk_position"])


def q_status_series_points(spark, sf):
    t = _star(spark, sf)
    series = dash.status_over_time(t["fait_etat_vol"], _dims(t), LO, HI)
    return dash.series_points(series, ["en_vol", "au_sol"])


def q_country_filter(spark, sf):
    fact = filters.time_range(_star(spark, sf)["fait_etat_vol"], "fk_temps", LO, HI)
    return filters.country_filter(fact, "NATION_7")


def q_adhoc_filter(spark, sf):
    fact = filters.time_range(_star(spark, sf)["fait_etat_vol"], "fk_temps", LO, HI)
    return filters.adhoc_filter(fact, [("fk_pays", "!=", "NATION_3"),
                                       ("geo_altitude", ">=", 1000.0),
                                       ("fk_pays", "=~", "^NATION_1[0-9]$")])


def _work(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid

    from flightlake.session import checkpoint_root
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


def _ended(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _inbox(spark, sf, work: str) -> None:
    """The fixture messages as files in two folders, split in time."""
    msgs = fx.flight_state_messages(spark, sf)
    late = (F.get_json_object("value", "$.time_position").cast("bigint")
            >= F.unix_seconds(F.lit(UPSERT_SPLIT).cast("timestamp")))
    for i, cond in enumerate([~F.coalesce(late, F.lit(False)), late]):
        msgs.filter(cond).select("value").write.text(f"{work}/inbox/part{i}")


def _stored_fact(spark, warehouse: str) -> DataFrame:
    from flightlake.plans.star_load import FACT, read_star
    return _utc_wall_clock(read_star(spark, warehouse)[FACT].drop("day"))


def q_fact_state_stream(spark, sf):
    """D7 + K1 through Structured Streaming: the fixture messages are dropped
    as files under the shared checkpoint folder, streamed with
    ``availableNow`` into a fresh warehouse, and the stored fact is read back."""
    from flightlake.sources.streams import file_stream
    from flightlake.streaming.pipelines import flight_star_stream

    work = _work(spark, "fact-stream")
    _inbox(spark, sf, work)
    _ended(flight_star_stream(file_stream(spark, f"{work}/inbox/*", max_files_per_trigger=64),
                              f"{work}/wh", f"{work}/ckpt", trigger={"availableNow": True}))
    return _stored_fact(spark, f"{work}/wh")


def q_fact_two_streams(spark, sf):
    """K1 twice: two streams with checkpoints of their own load one warehouse."""
    from flightlake.sources.streams import file_stream
    from flightlake.streaming.pipelines import flight_star_stream

    work = _work(spark, "two-streams")
    _inbox(spark, sf, work)
    for i in (0, 1):
        _ended(flight_star_stream(file_stream(spark, f"{work}/inbox/part{i}"), f"{work}/wh",
                                  f"{work}/ckpt{i}", trigger={"availableNow": True}))
    return _stored_fact(spark, f"{work}/wh")


def q_snapshot_star_stream(spark, sf):
    """S4 + P8 + P9 + D7 + K1: snapshot documents through the stream to the fact."""
    from flightlake.sources.streams import file_stream
    from flightlake.streaming.pipelines import flight_star_stream

    work = _work(spark, "snapshot-stream")
    fx.snapshot_documents(spark, sf).write.text(f"{work}/inbox")
    _ended(flight_star_stream(file_stream(spark, f"{work}/inbox"), f"{work}/wh", f"{work}/ckpt",
                              trigger={"availableNow": True}, snapshots=True))
    return _stored_fact(spark, f"{work}/wh")


def q_airport_routed_stored(spark, sf):
    """D8-D10 + K5: two streams route into one folder; all tables read back."""
    from flightlake.sources.streams import file_stream
    from flightlake.streaming.pipelines import airport_stream

    work = _work(spark, "routed")
    msgs = fx.airport_envelopes(spark, sf)
    even = F.get_json_object("value", "$.page").cast("int") % 2 == 0
    for i, cond in enumerate([even, ~even]):
        msgs.filter(cond).write.text(f"{work}/inbox{i}")
        _ended(airport_stream(file_stream(spark, f"{work}/inbox{i}"), f"{work}/ckpt{i}",
                              tables_path=f"{work}/tables", trigger={"availableNow": True}))
    return route.read_all_routed(spark, f"{work}/tables").drop("timestamp_ingestion")


def q_airport_routed_folded(spark, sf):
    """K5 folded while two streams write: batches before, between and after two folds."""
    from flightlake.streaming.pipelines import write_airport_messages

    tables = f"{_work(spark, 'routed-folded')}/tables"
    msgs = fx.airport_envelopes(spark, sf, page_size=10)
    page = F.get_json_object("value", "$.page").cast("int")
    for stream, n in [("a", 0), ("a", 1), ("b", 0), (None, 0), ("b", 1), ("b", 1), (None, 0), ("a", 2)]:
        if stream is None:
            route.fold_routed(spark, tables)
        else:
            part = {("a", 0): 0, ("a", 1): 1, ("b", 0): 2, ("b", 1): 3, ("a", 2): 4}[stream, n]
            write_airport_messages(msgs.filter(page % 5 == part), n, tables, stream=stream)
    return route.read_all_routed(spark, tables).drop("timestamp_ingestion")


def q_airport_quarantine(spark, sf):
    """Messages that yield no item, with their text."""
    return parse.airport_quarantine(fx.airport_envelopes(spark, sf, page_size=10, with_malformed=True))


def _stored(query):
    """A dashboard query over the stored star tables: ``query(fact, dims, times)``."""
    def run(spark, sf):
        from flightlake.plans.star_load import dashboard_tables, load_star_batch

        work = _work(spark, "star")
        load_star_batch(parse.flight_state_parse(fx.flight_state_messages(spark, sf)), 0, work)
        return _utc_wall_clock(query(*dashboard_tables(spark, work)))
    return run


def _ordered(query):
    """The rows of a query with the position each comes out at."""
    return lambda spark, sf: with_position(query(spark, sf))


def q_fact_stream_restart(spark, sf):
    """T5 + T6: two queries on one drop folder, each stopped after the first
    drop and started again on its checkpoint after the second; the fact, and
    the number of messages that the other query kept."""
    from flightlake.sources.streams import file_stream
    from flightlake.streaming.pipelines import flight_star_stream, message_archive

    work = _work(spark, "restart")
    msgs = fx.flight_state_messages(spark, sf)
    for i in (0, 1):
        msgs.filter(F.col("seq") % 2 == i).select("value").write.text(f"{work}/inbox/drop{i}")
        raw = lambda: file_stream(spark, f"{work}/inbox/*", max_files_per_trigger=64)
        for q in (flight_star_stream(raw(), f"{work}/wh", f"{work}/ckpt-star", trigger={"availableNow": True}),
                  message_archive(raw(), f"{work}/kept", f"{work}/ckpt-kept", trigger={"availableNow": True})):
            _ended(q)
    kept = spark.read.parquet(f"{work}/kept").agg(F.count("value")).scalar()
    return _stored_fact(spark, f"{work}/wh").withColumn("messages", kept)


def q_batch_metrics(spark, sf):
    """Rows written per batch and table; the batch between is empty."""
    from flightlake.streaming.pipelines import write_flight_batch

    work = _work(spark, "metrics")
    msgs = fx.flight_state_messages(spark, sf)
    for i, cond in enumerate([F.col("seq") % 3 == 0, F.lit(False), F.col("seq") % 3 > 0]):
        write_flight_batch(msgs.filter(cond), i, f"{work}/wh", metrics_path=f"{work}/metrics")
    return spark.read.parquet(f"{work}/metrics").select("batch_id", "target", "n_rows")


def q_fact_closed_days(spark, sf):
    """K3 while batches come in: days closed twice, with late rows between."""
    from flightlake.plans.star_load import close_days, load_star_batch

    work = _work(spark, "closed")
    msgs = fx.flight_state_messages(spark, sf)
    for i in range(4):
        load_star_batch(parse.flight_state_parse(msgs.filter(F.col("seq") % 4 == i)), i, work)
        if i in (1, 2):
            close_days(spark, work, ("2024-01-15", "2024-01-10")[i - 1])
    return _stored_fact(spark, work)


def q_airport_ingestion_time(spark, sf):
    """Every enriched row carries the time it was ingested."""
    rows = enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, sf)))
    return rows.groupBy(F.col("timestamp_ingestion").isNotNull().alias("stamped")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def _early_late():
    at = F.col("time_position")
    early = F.coalesce(at < F.lit(FIRST_SPLIT).cast("timestamp"), F.lit(False)) & F.col("callsign").isNull()
    return early, F.coalesce(at >= F.lit(UPSERT_SPLIT).cast("timestamp"), F.lit(False))


@contextlib.contextmanager
def _kept_states(spark, sf):
    """The parsed messages, kept while their batches are loaded: parsed once, not per batch."""
    states = parse.flight_state_parse(fx.flight_state_messages(spark, sf)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield states
    finally:
        states.unpersist()


def q_upsert_stored_batches(spark, sf):
    """K2 stored: three batches (the first without any callsign, the second
    loaded twice) into the five dimensions, read back as one list."""
    from flightlake.plans.star_load import load_star_batch, read_star

    work = _work(spark, "batches")
    early, late = _early_late()
    with _kept_states(spark, sf) as states:
        for i, cond in [(0, early), (1, ~early & ~late), (1, ~early & ~late), (2, late)]:
            load_star_batch(states.filter(cond), i, work, persist=False)
    return _listed(read_star(spark, work))


def q_upsert_folded_batches(spark, sf):
    """K2 folded while batches come in: after the second batch, which is then
    replayed, and after the third."""
    from flightlake.plans.star_load import fold_dimensions, load_star_batch, read_star

    work = _work(spark, "folded")
    early, late = _early_late()
    with _kept_states(spark, sf) as states:
        for i, cond in [(0, early), (1, ~early & ~late), (None, None), (1, ~early & ~late), (2, late), (None, None)]:
            if i is None:
                fold_dimensions(spark, work)
            else:
                load_star_batch(states.filter(cond), i, work, persist=False)
    return _listed(read_star(spark, work))


def _listed(t) -> DataFrame:
    """The five dimensions as one list."""
    text, flag, number = F.lit(None).cast("string"), F.lit(None).cast("boolean"), F.lit(None).cast("double")
    rows = [
        ("dim_pays", "pk_pays", flag, text, number, text),
        ("dim_vol", "pk_vol", F.col("on_ground"), F.col("squawk"), number, text),
        ("dim_temps", "pk_temps", flag, F.col("jour_capture"), number, text),
        ("dim_aeronef", "pk_aeronef", flag, text, F.col("category"), text),
        ("dim_position", "pk_position", F.col("on_ground"), text, F.col("geo_altitude"), F.col("position_source")),
    ]
    key = lambda k: F.date_format(k, "yyyy-MM-dd HH:mm:ss") if k == "pk_temps" else F.col(k)
    lists = [t[n].select(F.lit(n).alias("dim"), key(k).alias("pk"), g.alias("on_ground"), s.alias("txt"),
                         a.alias("num"), o.alias("position_source")) for n, k, g, s, a, o in rows]
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more)
    return out


def q_time_range_other_zone(spark, sf):
    """the fact is stored in a UTC session and read in another zone."""
    import datetime as dt

    from flightlake.plans.star_load import FACT, load_star_batch, read_star

    work = _work(spark, "zone")
    load_star_batch(parse.flight_state_parse(fx.flight_state_messages(spark, sf)), 0, work)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    lo, hi = (dt.datetime.fromisoformat(x).replace(tzinfo=dt.timezone.utc) for x in (ZONE_LO, ZONE_HI))
    rows = filters.time_range(read_star(spark, work)[FACT], "fk_temps", lo, hi)
    return rows.select("fk_aeronef", "fk_position", F.unix_seconds("fk_temps").alias("t"))


def q_adhoc_filter_numeric(spark, sf):
    """F8 on integer columns with fractional values."""
    rows = filters.adhoc_filter(_airports(spark, sf), [("altitude_estimee_m", "<", "300.5"),
                                                       ("altitude_estimee_m", ">=", 149.5),
                                                       ("timezone_approx", "!=", 2.5),
                                                       ("timezone_approx", ">=", "-3")])
    return rows.select("name", "icao", "source_data", "latitude", "altitude_estimee_m", "timezone_approx")


def q_positional_wrong_types(spark, sf):
    """P9 on documents whose values often have another type than the field."""
    n = F.col("event_id")
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    s = n.cast("string")
    values = [
        F.when(n % 3 == 0, s).otherwise(text(F.concat(F.lit("s"), s))),
        F.when(n % 4 == 0, text(F.lit("7000"))).when(n % 4 == 1, "true").when(n % 4 == 2, "2.5").otherwise(s),
        F.when(n % 2 == 0, text(F.lit("x"))).otherwise(F.concat(s, F.lit(".5"))),
        F.when(n % 5 == 0, "1").when(n % 5 == 1, "null").when(n % 5 == 2, text(F.lit("true"))).otherwise("true"),
    ]
    doc = F.concat(F.lit('{"time":'), s, F.lit(',"states":[[') , F.concat_ws(",", *values), F.lit("],null]}"))
    docs = fx.table(spark, sf, "events").select(doc.alias("value"))
    return parse.positional_to_named(parse.snapshot_split(docs), [
        ("a", "string"), ("b", "bigint"), ("c", "double"), ("d", "boolean"), ("e", "string")])


UPSERT_SPLIT = "2024-01-15 00:00:00"
FIRST_SPLIT = "2024-01-08 00:00:00"
ZONE_LO, ZONE_HI = "2024-01-05 23:30:00", "2024-01-08 00:30:00"


def q_upsert_two_batches(spark, sf):
    """K2 across two batches: states before the split (or without a time)
    first, the rest second; the second batch's rows replace the first's."""
    states = fx.flight_states(spark, sf)
    late = F.col("time_position") >= F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    first = star.dim_position(states.filter(~late | F.col("time_position").isNull()))
    second = star.dim_position(states.filter(late))
    return upsert.merge_upsert(first, second, "pk_position")


def _airports(spark, sf):
    """Envelopes -> parse -> enrich; the ingestion time is left out (not
    reproducible between engines)."""
    rows = enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, sf)))
    return rows.drop("timestamp_ingestion")


def q_airport_enrich(spark, sf):
    return _airports(spark, sf)


def q_airport_route_counts(spark, sf):
    return route.route_counts(_airports(spark, sf))


def q_airfield_preview(spark, sf):
    return air.airfield_preview(route.routed_table(_airports(spark, sf), "airfields"))


def q_hotspot_geo_score(spark, sf):
    return _r6(air.hotspot_geo_score(route.routed_table(_airports(spark, sf), "hotspots")), "avg")


def q_airfield_table(spark, sf):
    cols = [c for c in air.AIRFIELD_TABLE_COLUMNS if c != "timestamp_ingestion"]
    return air.airfield_table(route.routed_table(_airports(spark, sf), "airfields"), columns=cols)


def q_country_altitude(spark, sf):
    return air.country_altitude(route.routed_table(_airports(spark, sf), "airports"))


# Snapshot pairs: every hour's snapshot against the hour before it; the job
# time is the later hour + 30 s. Fields read back with ``spi`` as a number,
# which parity arithmetic on booleans produces.
_EXTRAPOLATED_FIELDS = [
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"),
    ("time_position", "bigint"), ("last_contact", "bigint"), ("longitude", "double"),
    ("latitude", "double"), ("baro_altitude", "double"), ("on_ground", "boolean"),
    ("velocity", "double"), ("true_track", "double"), ("vertical_rate", "double"),
    ("sensors", "array<int>"), ("geo_altitude", "double"), ("squawk", "string"),
    ("spi", "bigint"), ("position_source", "bigint"),
]


def q_snapshot_extrapolate(spark, sf):
    snaps = fx.snapshot_states(spark, sf)
    prev = snaps.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    job_time = F.unix_seconds(F.col("snap").cast("timestamp")) + F.lit(30)
    out = extrapolate.extrapolate(snaps, prev, job_time, by=["snap"])
    return parse.positional_to_named(out, _EXTRAPOLATED_FIELDS, keep=("snap", "time", "pos"), convert=True)


def q_snapshot_extrapolate_by_key(spark, sf):
    """J5 option: pair states by aircraft (element 0) instead of list position."""
    snaps = fx.snapshot_states(spark, sf)
    prev = snaps.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    job_time = F.unix_seconds(F.col("snap").cast("timestamp")) + F.lit(30)
    out = extrapolate.extrapolate(snaps, prev, job_time, by=["snap"], key_index=0)
    return parse.positional_to_named(out, _EXTRAPOLATED_FIELDS, keep=("snap", "time", "pos"), convert=True)


def q_snapshot_extrapolate_steps(spark, sf):
    """R1 with ``steps=3``: three generator cycles against one previous snapshot."""
    snaps = fx.snapshot_states(spark, sf)
    prev = snaps.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    job_time = F.unix_seconds(F.col("snap").cast("timestamp")) + F.lit(30)
    out = extrapolate.extrapolate(snaps, prev, job_time, by=["snap"], steps=3)
    return parse.positional_to_named(out, _EXTRAPOLATED_FIELDS, keep=("snap", "time", "pos"), convert=True)


def q_snapshot_extrapolate_steps16(spark, sf):
    """R1 over typed columns, 16 generator cycles in closed form."""
    snaps = fx.snapshot_rows(spark, sf)
    prev = snaps.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    job_time = F.unix_seconds(F.col("snap").cast("timestamp")) + F.lit(30)
    return extrapolate.extrapolate_named(snaps, prev, job_time, SNAPSHOT_FIELDS[:17], by=["snap"], steps=16)


def _paged(states: DataFrame, size: int = 5) -> DataFrame:
    """Snapshot states as pages of ``size`` with long names, positions from 0 in each."""
    no = F.floor(F.col("pos") / F.lit(size)).cast("int")
    name = F.concat(F.date_format("snap", "yyyy-MM-dd'T'HH"), F.lit("-page"), (no + 1).cast("string"))
    return states.select(F.unix_seconds(F.col("snap").cast("timestamp")).alias("time"), name.alias("page"),
                         no.alias("page_no"), (F.col("pos") % size).alias("pos"), "state")


def q_snapshot_table_pair(spark, sf):
    """K9 + J5: the two latest snapshots of a table whose pages were stored out
    of order (some twice), paired by list position."""
    from flightlake.operators import snapshots

    path = f"{_work(spark, 'snapshots')}/table"
    pages = _paged(fx.snapshot_states(spark, sf))
    for load, cond in [("b", F.col("page_no") % 2 == 1), ("a", F.col("page_no") % 2 == 0),
                       ("a", F.col("page_no") % 2 == 0), ("c", F.col("page_no") == 1)]:
        snapshots.write_snapshot(pages.filter(cond), path, load_id=load)
    previous, current = snapshots.latest_two(spark, path)
    name = F.try_variant_get(F.get("state", 0), "$", "string")
    return (current.select("time", "pos", name.alias("icao24"))
            .join(previous.select("pos", name.alias("previous_icao24")), "pos", "left"))


def q_snapshot_documents_back(spark, sf):
    """R1 + K9: generated snapshots as whole documents in pieces, as text files,
    and back through the parser and the snapshot table."""
    from flightlake.operators import snapshots

    work = _work(spark, "documents")
    snaps = fx.snapshot_states(spark, sf)
    prev = snaps.withColumn("snap", F.col("snap") + F.expr("INTERVAL 1 HOUR"))
    job_time = F.unix_seconds(F.col("snap").cast("timestamp")) + F.lit(30)
    docs = extrapolate.to_documents(extrapolate.extrapolate(snaps, prev, job_time, by=["snap"]), by=["snap"], page_size=5)
    docs.select("page_no", "value").write.partitionBy("page_no").text(f"{work}/documents")
    back = parse.snapshot_split(spark.read.text(f"{work}/documents"), keep=("page_no",))
    snapshots.write_snapshot(back.withColumn("page", F.concat(F.lit("p"), F.col("page_no").cast("string"))), f"{work}/table")
    stored = snapshots.numbered(snapshots.read_snapshots_table(spark, f"{work}/table").drop("day"))
    return parse.positional_to_named(stored, _EXTRAPOLATED_FIELDS, convert=True)


def q_snapshot_files(spark, sf):
    """S3: snapshot documents from files, one in each."""
    from flightlake.sources.streams import read_snapshots

    work = _work(spark, "snapshot-files")
    # One file a document: moved into place by the tasks, not one by one by the driver.
    (fx.snapshot_documents(spark, sf).write.option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(f"{work}/docs"))
    return parse.positional_to_named(read_snapshots(spark, f"{work}/docs"))


def q_snapshot_split(spark, sf):
    return parse.positional_to_named(parse.snapshot_split(fx.snapshot_documents(spark, sf)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _utc(fn) for name, fn in _QUERIES.items()}
    if _llm is not None:
        out |= _llm.queries()
    if _pipeline is not None:
        out["pipeline"] = _utc(_pipeline.run)
    return out


def _registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "state_mapping": q_state_mapping,
        "state_quarantine": q_state_quarantine,
        "dim_country": _dim("dim_pays"),
        "dim_flight": _dim("dim_vol"),
        "dim_time": _dim("dim_temps"),
        "dim_aircraft": _dim("dim_aeronef"),
        "dim_position": _dim("dim_position"),
        "fact_state": _dim("fait_etat_vol"),
        "upsert_two_batches": q_upsert_two_batches,
        "fact_state_stream": q_fact_state_stream,
        "fleet_status": q_fleet_status,
        "live_map": q_live_map,
        "status_over_time": q_status_over_time,
        "status_share": q_status_share,
        "top_countries": q_top_countries,
        "vertical_over_time": q_vertical_over_time,
        "altitude_bands": q_altitude_bands,
        "country_options": q_country_options,
        "status_last_non_null": q_status_last_non_null,
        "status_series_points": q_status_series_points,
        "country_filter": q_country_filter,
        "adhoc_filter": q_adhoc_filter,
        "airport_enrich": q_airport_enrich,
        "airport_route_counts": q_airport_route_counts,
        "airfield_preview": q_airfield_preview,
        "hotspot_geo_score": q_hotspot_geo_score,
        "airfield_table": q_airfield_table,
        "country_altitude": q_country_altitude,
        "snapshot_extrapolate": q_snapshot_extrapolate,
        "snapshot_split": q_snapshot_split,
        "snapshot_extrapolate_by_key": q_snapshot_extrapolate_by_key,
        "snapshot_extrapolate_steps": q_snapshot_extrapolate_steps,
        "state_mapping_binary": q_state_mapping_binary,
        "airport_ingestion_time": q_airport_ingestion_time,
        "fleet_status_stored": _stored(lambda fact, dims, times: _r6(
            dash.fleet_status(fact, LO, HI, times), "Vitesse moyenne (km/h)", "Altitude géo moyenne (m)")),
        "status_share_stored": _stored(
            lambda fact, dims, times: dash.share_of_total(dash.status_split(fact, LO, HI, times), "nb_avions")),
        "altitude_bands_stored": _stored(lambda fact, dims, times: dash.altitude_bands(fact, LO, HI, times=times)),
        "live_map_stored": _stored(lambda fact, dims, times: dash.live_map(fact, *(dims or (None,) * 3), lo=LO, hi=HI)),
        "status_over_time_stored": _stored(lambda fact, dims, times: dash.status_over_time(fact, dims, LO, HI)),
        "vertical_over_time_stored": _stored(lambda fact, dims, times: dash.vertical_over_time(fact, dims, LO, HI)),
        "upsert_folded_batches": q_upsert_folded_batches,
        "fact_closed_days": q_fact_closed_days,
        "airport_routed_folded": q_airport_routed_folded,
        "airport_quarantine": q_airport_quarantine,
        "fact_stream_restart": q_fact_stream_restart,
        "batch_metrics": q_batch_metrics,
        "snapshot_extrapolate_steps16": q_snapshot_extrapolate_steps16,
        "snapshot_table_pair": q_snapshot_table_pair,
        "snapshot_documents_back": q_snapshot_documents_back,
        "snapshot_files": q_snapshot_files,
        "status_over_time_order": _ordered(q_status_over_time),
        "vertical_over_time_order": _ordered(q_vertical_over_time),
        "altitude_bands_order": _ordered(q_altitude_bands),
        "country_options_order": _ordered(q_country_options),
        "fact_two_streams": q_fact_two_streams,
        "snapshot_star_stream": q_snapshot_star_stream,
        "airport_routed_stored": q_airport_routed_stored,
        "upsert_stored_batches": q_upsert_stored_batches,
        "time_range_other_zone": q_time_range_other_zone,
        "adhoc_filter_numeric": q_adhoc_filter_numeric,
        "positional_wrong_types": q_positional_wrong_types,
    }


_QUERIES = _registry()


def oracle_sql() -> dict[str, str]:
    sql = dict(_oracle_sql())
    if _llm is not None:
        sql |= _llm.oracle_sql()
    if _pipeline is not None and _pipeline.ORACLE_SQL:
        sql["pipeline"] = _pipeline.ORACLE_SQL
    return {k: sql[k] for k in queries() if k in sql}
