"""Feeds derived from the driver's tables (FIXTURES.md §6-8).

The reference's own domain tables are not in the test data, so flight states
are derived from ``events`` joined to ``nation`` and airport items from
``customer`` joined to ``nation``. All of it is lazy DataFrame code: the work
grows with ``events`` / ``customer`` and is partitioned like them.

``nation`` is 25 rows at every scale factor (fixed by the TPC-H definition),
so the planner broadcasts it by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.schemas import AIRPORT_SOURCES, SNAPSHOT_FIELDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def flight_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped flight states (the D7 output shape) with a ``seq`` tie-break column.

    Nulls, zeros, ties, missing callsigns and negative altitudes are there on
    purpose. Timestamps are TIMESTAMP_NTZ, like the source ``events.ts``.
    """
    e = table(spark, sf_dir, "events")
    n = _nation(spark, sf_dir)
    eid = F.col("event_id")
    j = e.join(n, n.n_nationkey == (e.user_id % 25))
    coord = lambda mult, mod, off: (
        (eid * mult % mod - off).cast("double") / F.lit(100.0))
    return j.select(
        F.concat(F.lit("a"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("icao24"),
        F.when(eid % 53 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("FL"), (F.col("user_id") % 40).cast("string"))).alias("callsign"),
        F.col("n_name").alias("origin_country"),
        F.when(eid % 61 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("time_position"),
        F.col("ts").alias("last_contact"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
         .when(eid % 89 == 0, F.lit(0.0)).otherwise(coord(53, 36001, 18000)).alias("longitude"),
        F.when(eid % 89 == 0, F.lit(0.0)).otherwise(coord(37, 18001, 9000)).alias("latitude"),
        (F.col("value") * 29).alias("baro_altitude"),
        F.when(eid % 13 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") * 30 - 1500).alias("geo_altitude"),
        F.when(F.col("event_type") == "signup", F.lit(True))
         .when(F.col("event_type") == "error", F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("on_ground"),
        F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("velocity"),
        (eid % 360).cast("double").alias("true_track"),
        F.when(eid % 19 == 0, F.lit(None).cast("double"))
         .otherwise((eid % 41 - 20).cast("double")).alias("vertical_rate"),
        (eid % 7777).cast("string").alias("squawk"),
        (eid % 29 == 0).alias("spi"),
        (eid % 4).cast("string").alias("position_source"),
        F.lit(None).cast("double").alias("category"),
        eid.alias("seq"),
    )


def flight_state_messages(spark: SparkSession, sf_dir: str,
                          with_malformed: bool = False) -> DataFrame:
    """One JSON text per state, epochs in seconds: the raw feed form (``value``).

    ``with_malformed`` replaces some messages by a JSON array (the positional
    form a flat-schema parse cannot read) or by text that is not JSON.
    """
    s = flight_states(spark, sf_dir)
    as_epoch = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    obj = F.struct(
        "icao24", "callsign", "origin_country",
        as_epoch("time_position").alias("time_position"),
        as_epoch("last_contact").alias("last_contact"),
        "longitude", "latitude", "baro_altitude", "on_ground", "velocity",
        "true_track", "vertical_rate", "geo_altitude", "squawk", "spi",
        F.col("position_source").cast("bigint").alias("position_source"),
        "category",
    )
    value = F.to_json(obj)
    if with_malformed:
        seq = F.col("seq")
        value = (F.when(seq % 47 == 0, F.concat(F.lit('["'), F.col("icao24"), F.lit('",'),
                                                seq.cast("string"), F.lit("]")))
                 .when(seq % 83 == 0, F.concat(F.lit("not json "), seq.cast("string")))
                 .otherwise(value))
    return s.select(value.alias("value"), "seq")


def airport_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat airport items with routing source, ``seq`` tie-break."""
    c = table(spark, sf_dir, "customer")
    n = _nation(spark, sf_dir)
    k = F.col("c_custkey")
    j = c.join(n, n.n_nationkey == c.c_nationkey)
    src = F.lit(None).cast("string")
    # custkey % 10: 0..7 -> the eight tables in order, 8 -> unknown, 9 -> null.
    src = F.when(k % 10 == 8, F.lit("elsewhere")).otherwise(src)
    for i, name in reversed(list(enumerate(AIRPORT_SOURCES))):
        src = F.when(k % 10 == i, F.lit(name)).otherwise(src)
    lon_null = k % 43 == 0
    return j.select(
        k.alias("seq"),
        src.alias("source_data"),
        F.when(k % 31 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("name"),
        F.col("n_name").alias("country"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.substring(F.lit("KESZYLA"), (k % 7 + 1).cast("int"), 1),
                             F.lpad((k % 1000).cast("string"), 3, "0"))).alias("icao"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.lpad((k % 1000).cast("string"), 3, "X")).alias("iata"),
        F.when(lon_null, F.lit(None).cast("double"))
         .otherwise((k * 53 % 36001 - 18000).cast("double") / F.lit(100.0)).alias("longitude"),
        F.when(lon_null | (k % 41 == 0), F.lit(None).cast("double"))
         .otherwise((k * 37 % 18001 - 9000).cast("double") / F.lit(100.0)).alias("latitude"),
    )


def airport_envelopes(spark: SparkSession, sf_dir: str, page_size: int = 100,
                      with_malformed: bool = False) -> DataFrame:
    """Airport items wrapped as JSON envelopes (the raw feed form ``value``).
    ``with_malformed`` replaces those of some pages by text that is not JSON, a
    JSON array, or an envelope without items.

    One message per (source, page of ``page_size`` items): a group never holds
    more than ``page_size`` items, whatever the scale.
    """
    it = airport_items(spark, sf_dir)
    geometry = F.when(F.col("longitude").isNull(), F.lit(None)).otherwise(F.struct(
        F.lit("Point").alias("type"),
        F.when(F.col("latitude").isNull(), F.array(F.col("longitude")))
         .otherwise(F.array("longitude", "latitude")).alias("coordinates")))
    item = F.struct(F.col("name"), F.col("country"), F.col("icao").alias("icaoCode"),
                    F.col("iata").alias("iataCode"), geometry.alias("geometry"))
    paged = it.withColumn("page", (F.col("seq") / F.lit(10 * page_size)).cast("int"))
    env = (paged.groupBy("source_data", "page")
           .agg(F.sort_array(F.collect_list(F.struct("seq", item.alias("item")))).alias("its")))
    body = F.struct(
        F.lit(page_size).alias("limit"),
        F.size("its").alias("totalCount"),
        F.lit(1).alias("totalPages"),
        F.col("page"),
        F.transform("its", lambda x: x["item"]).alias("items"),
        F.col("source_data"),
    )
    value = F.to_json(body)
    if with_malformed:
        page = F.col("page").cast("string")
        name = F.coalesce("source_data", F.lit("none"))
        value = (F.when(F.col("page") % 5 == 1, F.concat(F.lit("not json "), name, page))
                 .when(F.col("page") % 5 == 2, F.concat(F.lit('["'), name, F.lit('",'), page, F.lit("]")))
                 .when(F.col("page") % 5 == 3, F.concat(F.lit('{"source_data":"'), name, F.lit('","page":'), page, F.lit(',"items":[]}')))
                 .otherwise(value))
    return env.select(value.alias("value"))


# State-vector positions of a snapshot document built from the
# fixture (index 12, the sensor list, is always null here).
SNAPSHOT_LAYOUT = ["icao24", "callsign", "origin_country", "time_position", "last_contact",
                   "longitude", "latitude", "baro_altitude", "on_ground", "velocity",
                   "true_track", "vertical_rate", None, "geo_altitude", "squawk", "spi",
                   "position_source"]


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per hour of ``last_contact`` (FIXTURES.md §8): the latest
    state of each aircraft in that hour, listed in ``icao24`` order, as typed
    columns (``schemas.SNAPSHOT_FIELDS``, epochs in seconds) after ``snap`` (hour,
    TIMESTAMP_NTZ) and ``pos`` (list position). Positions are numbered by
    ``assign_positions``, so no task holds a whole snapshot.
    """
    from flightlake.operators.dedup import latest_per_key
    from flightlake.operators.snapshots import assign_positions

    s = flight_states(spark, sf_dir).withColumn(
        "snap", F.date_trunc("hour", "last_contact").cast("timestamp_ntz"))
    latest = latest_per_key(s, ["snap", "icao24"],
                            [F.col("last_contact").desc(), F.col("seq").desc()])
    ranked = assign_positions(latest, ["snap"], "icao24")
    epoch = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    typed = {"time_position": epoch("time_position"), "last_contact": epoch("last_contact"),
             "position_source": F.col("position_source").cast("bigint"),
             "sensors": F.lit(None).cast("array<int>")}
    return ranked.select("snap", "pos", *[typed.get(n, F.col(n)).alias(n) for n, _ in SNAPSHOT_FIELDS[:17]])


def snapshot_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``snapshot_rows`` as ``snap``, ``pos`` and ``state`` (ARRAY<VARIANT>)."""
    elems = [F.lit(None).cast("variant") if name is None else F.col(name).cast("variant") for name in SNAPSHOT_LAYOUT]
    return snapshot_rows(spark, sf_dir).select("snap", "pos", F.array(*elems).alias("state"))


def snapshot_documents(spark: SparkSession, sf_dir: str, page_size: int = 50) -> DataFrame:
    """Snapshot states as JSON documents ``{"time", "states"}`` of at most
    ``page_size`` states each (one document per hour and page)."""
    st = snapshot_states(spark, sf_dir).withColumn(
        "page", (F.col("pos") / F.lit(page_size)).cast("int"))
    by_pos = lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)
    docs = (st.groupBy("snap", "page")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "state")), by_pos).alias("rows")))
    body = F.struct(F.unix_seconds(F.col("snap").cast("timestamp")).alias("time"),
                    F.transform("rows", lambda r: r["state"]).alias("states"))
    return docs.select(F.to_json(body).alias("value"))
