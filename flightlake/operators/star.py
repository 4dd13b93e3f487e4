"""Star schema from one batch of mapped states.

Each builder takes the mapped-state DataFrame of one (micro-)batch and returns
the rows to upsert (dimensions: one per key) or append (fact). Several rows
with one key in a batch resolve deterministically: latest ``time_position``,
then latest ``last_contact``, then the row's own columns as a total tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.columns import position_key, time_parts
from flightlake.operators.dedup import asc_last, desc_last, latest_per_key
from flightlake.schemas import (
    DIM_AIRCRAFT_COLS, DIM_COUNTRY_COLS, DIM_FLIGHT_COLS, DIM_POSITION_COLS,
    DIM_TIME_COLS, FACT_COLS, FACT_KEYS,
)

EVENT_ORDER = ["time_position", "last_contact"]


def _latest(rows: DataFrame, key: str, cols: list[str]) -> DataFrame:
    order = [desc_last(c) for c in EVENT_ORDER] + [asc_last(c) for c in cols if c != key]
    return latest_per_key(rows.filter(F.col(key).isNotNull()), [key], order).select(*cols)


def dim_country(states: DataFrame) -> DataFrame:
    """D1 ``dim_pays``: key = name = origin country."""
    return (states.select(F.col("origin_country").alias("pk_pays"),
                          F.col("origin_country").alias("nom_pays"))
            .filter(F.col("pk_pays").isNotNull()).distinct()
            .select(*DIM_COUNTRY_COLS))


def dim_flight(states: DataFrame) -> DataFrame:
    """D2 ``dim_vol``: one row per callsign, latest ground flag and squawk."""
    rows = states.select(F.col("callsign").alias("pk_vol"), "callsign", "on_ground",
                         "squawk", *EVENT_ORDER)
    return _latest(rows, "pk_vol", DIM_FLIGHT_COLS)


def dim_time(states: DataFrame) -> DataFrame:
    """D3 ``dim_temps``: every column is a function of the key, so plain distinct."""
    parts = time_parts("time_position")
    return (states.select(F.col("time_position").alias("pk_temps"),
                          *[v.alias(k) for k, v in parts.items()])
            .filter(F.col("pk_temps").isNotNull()).distinct()
            .select(*DIM_TIME_COLS))


def dim_aircraft(states: DataFrame) -> DataFrame:
    """D4 ``dim_aeronef``: one row per icao24 (category is null unless kept)."""
    rows = states.select(F.col("icao24").alias("pk_aeronef"), "category", *EVENT_ORDER)
    return _latest(rows, "pk_aeronef", DIM_AIRCRAFT_COLS)


def dim_position(states: DataFrame) -> DataFrame:
    """D5 ``dim_position``: key ``"lat_lon"``; no row when either is null."""
    rows = states.select(position_key().alias("pk_position"), "latitude", "longitude",
                         "geo_altitude", "on_ground", "position_source", *EVENT_ORDER)
    return _latest(rows, "pk_position", DIM_POSITION_COLS)


def fact_state(states: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """D6 ``fait_etat_vol``: one row per state with all four foreign keys set.

    A null callsign keeps the row (no flight key in the fact); a null
    latitude or longitude drops it (no position key).
    """
    rows = states.select(
        F.col("time_position").alias("fk_temps"),
        F.col("icao24").alias("fk_aeronef"),
        position_key().alias("fk_position"),
        F.col("origin_country").alias("fk_pays"),
        "baro_altitude", "geo_altitude", "velocity", "vertical_rate", "true_track",
        "on_ground", "spi", "position_source", "last_contact", *extra,
    )
    return rows.dropna(subset=FACT_KEYS).select(*FACT_COLS, *extra)


def star(states: DataFrame) -> dict[str, DataFrame]:
    """All six tables of one batch, by table name."""
    return {
        "dim_pays": dim_country(states),
        "dim_vol": dim_flight(states),
        "dim_temps": dim_time(states),
        "dim_aeronef": dim_aircraft(states),
        "dim_position": dim_position(states),
        "fait_etat_vol": fact_state(states),
    }
