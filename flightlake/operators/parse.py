"""Parsing and flattening of raw messages.

All functions accept a DataFrame holding the raw message in a column
(``value``: binary from Kafka or text from files) and work unchanged on a
streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from flightlake.functions.columns import epoch_to_timestamp
from flightlake.schemas import (
    AIRPORT_ENVELOPE_SCHEMA, FLIGHT_STATE_SCHEMA, SNAPSHOT_DDL, SNAPSHOT_FIELDS,
)

def as_text(df: DataFrame, col: str = "value") -> Column:
    """Kafka's binary ``value`` (or text already) as STRING."""
    c = F.col(col)
    return c.cast("string") if isinstance(df.schema[col].dataType, BinaryType) else c


def parse_json_struct(df: DataFrame, schema: StructType, col: str = "value",
                      keep_raw: bool = False) -> DataFrame:
    """P2/P3 + P4: ``from_json`` with a fixed schema (PERMISSIVE) and star-expand.

    Malformed text gives a struct of nulls, like the reference.
    """
    parsed = F.from_json(as_text(df, col), schema).alias("data")
    cols = [parsed] + ([as_text(df, col).alias("_raw")] if keep_raw else [])
    return df.select(*cols).select("data.*", *(["_raw"] if keep_raw else []))


def map_flight_state(df: DataFrame, keep_category: bool = False) -> DataFrame:
    """Flat parsed state -> the 17 mapped columns.

    Epochs become TIMESTAMP without a detour through a zone-dependent string,
    ``position_source`` becomes STRING and ``category`` is a typed null unless
    ``keep_category``.
    """
    category = F.col("category") if keep_category else F.lit(None).cast("double")
    return df.select(
        epoch_to_timestamp("time_position").alias("time_position"),
        "icao24", "callsign", "origin_country", "longitude", "latitude",
        "baro_altitude", "geo_altitude", "velocity", "vertical_rate", "true_track",
        "on_ground", "spi",
        F.col("position_source").cast("string").alias("position_source"),
        "squawk",
        category.alias("category"),
        epoch_to_timestamp("last_contact").alias("last_contact"),
    )


def flight_state_parse(df: DataFrame, col: str = "value",
                       keep_category: bool = False) -> DataFrame:
    """Raw flight-state messages -> mapped states (17 columns)."""
    return map_flight_state(parse_json_struct(df, FLIGHT_STATE_SCHEMA, col), keep_category)


def _all_fields_null() -> Column:
    all_null = None
    for f in FLIGHT_STATE_SCHEMA.fieldNames():
        cond = F.col(f).isNull()
        all_null = cond if all_null is None else (all_null & cond)
    return all_null


def flight_state_parse_with_raw(df: DataFrame, col: str = "value") -> DataFrame:
    """Flat parsed fields plus ``_raw`` text and ``_bad`` (parsed to nulls
    only), so one parse feeds both the star load and the quarantine."""
    return (parse_json_struct(df, FLIGHT_STATE_SCHEMA, col, keep_raw=True)
            .withColumn("_bad", _all_fields_null()))


def quarantined(parsed_with_raw: DataFrame) -> DataFrame:
    return (parsed_with_raw.filter(F.col("_bad") & F.col("_raw").isNotNull())
            .select(F.col("_raw").alias("raw")))


def flight_state_quarantine(df: DataFrame, col: str = "value") -> DataFrame:
    """Messages that parsed to a struct of nulls (malformed JSON, arrays, ...),
    kept with their raw text. They would otherwise vanish silently."""
    return quarantined(flight_state_parse_with_raw(df, col))


def snapshot_states_with_raw(df: DataFrame, col: str = "value") -> DataFrame:
    """Snapshot documents -> the parsed fields of their states, like
    ``flight_state_parse_with_raw``. A document that cannot be read, or has no
    list of states, is one bad row with its raw text; so is a state without
    any value, without text."""
    doc = df.select(as_text(df, col).alias("_raw")).withColumn(
        "d", F.from_json("_raw", SNAPSHOT_DDL))
    rows = doc.select(F.when(F.col("d.states").isNull(), F.col("_raw")).alias("_raw"),
                      F.explode_outer("d.states").alias("state"))
    named = positional_to_named(rows, keep=("_raw",))
    kinds = {f.name: f.dataType for f in FLIGHT_STATE_SCHEMA}
    return (named.select(*[F.col(n).cast(t).alias(n) for n, t in kinds.items()], "_raw")
            .withColumn("_bad", _all_fields_null()))


AIRPORT_TEXT_COLUMNS = ["name", "icao", "iata", "country"]


def airport_envelopes_with_raw(df: DataFrame, col: str = "value") -> DataFrame:
    """Parsed envelopes as ``data``, the text of the message as ``_raw``, and
    ``_bad`` where it yields no item: text that is no envelope, or one without
    items. So one parse feeds both the tables and the quarantine."""
    env = df.select(as_text(df, col).alias("_raw")).withColumn("data", F.from_json("_raw", AIRPORT_ENVELOPE_SCHEMA))
    return env.withColumn("_bad", F.coalesce(F.size("data.items"), F.lit(0)) <= 0)


def airport_quarantine(df: DataFrame, col: str = "value") -> DataFrame:
    """Airport messages that yield no item, kept with their raw text."""
    return quarantined(airport_envelopes_with_raw(df, col))


def airport_parse(df: DataFrame, col: str = "value") -> DataFrame:
    """Envelope -> one row per airport item, flattened; nulls in the four
    text fields become "N/A".

    ``explode`` drops null/empty ``items`` (``airport_quarantine`` keeps such
    messages).
    """
    env = df.select(F.from_json(as_text(df, col), AIRPORT_ENVELOPE_SCHEMA).alias("data"))
    return airport_rows(env)


def airport_rows(env: DataFrame) -> DataFrame:
    """The items of parsed envelopes (``data``). ``F.get`` returns null for a
    short ``coordinates`` array instead of failing under ANSI mode."""
    items = env.select(F.col("data.source_data").alias("source_data"),
                       F.explode("data.items").alias("airport"))
    coords = F.col("airport.geometry.coordinates")
    flat = items.select(
        F.col("airport.name").alias("name"),
        F.col("airport.icaoCode").alias("icao"),
        F.col("airport.iataCode").alias("iata"),
        F.col("airport.country").alias("country"),
        F.get(coords, 0).alias("longitude"),
        F.get(coords, 1).alias("latitude"),
        F.col("source_data"),
    )
    return flat.fillna("N/A", subset=AIRPORT_TEXT_COLUMNS)


# --- snapshots (P8, P9) -----------------------------------------------------

def snapshot_split(df: DataFrame, col: str = "value", keep: tuple = ()) -> DataFrame:
    """Snapshot documents -> one row per state vector.

    Output: ``time`` (document epoch), ``pos`` (list position) and ``state``
    (ARRAY<VARIANT>, which keeps the difference between ``"7000"`` and
    ``7000`` and between JSON null and a missing element), after the columns of
    the message named in ``keep`` (a page number).
    """
    doc = df.select(*keep, F.from_json(as_text(df, col), SNAPSHOT_DDL).alias("d"))
    rows = doc.select(*keep, F.col("d.time").alias("time"),
                      F.posexplode("d.states").alias("pos", "state"))
    # A null element is an empty record: a state without values, at its place.
    return rows.withColumn("state", F.coalesce("state", F.array().cast("array<variant>")))


_INTEGERS = ["TINYINT", "SMALLINT", "INT", "BIGINT"]


def _has_type(value: Column, typ: str) -> Column:
    """Whether a variant holds a value of ``typ`` (an integer is also a double)."""
    tag = F.schema_of_variant(value)
    whole = tag.isin(_INTEGERS) | (tag.startswith("DECIMAL") & tag.endswith(",0)"))
    if typ == "string":
        return tag == "STRING"
    if typ == "boolean":
        return tag == "BOOLEAN"
    if typ in ("int", "bigint"):
        return whole
    if typ == "double":
        return whole | tag.isin("FLOAT", "DOUBLE") | tag.startswith("DECIMAL")
    return tag.startswith("ARRAY")


def positional_to_named(df: DataFrame, fields=None, col: str = "state",
                        keep: tuple = ("time", "pos"), convert: bool = False) -> DataFrame:
    """Positional state array -> named, typed columns.

    ``fields`` is a list of (name, spark type) in position order. A value of
    the wrong type or a missing position becomes null; ``convert`` casts values
    of another type where that is possible instead.
    """
    fields = fields or SNAPSHOT_FIELDS
    arr = F.col(col)
    cols = [F.col(k) for k in keep if k in df.columns]
    for i, (name, typ) in enumerate(fields):
        value = F.try_variant_get(F.get(arr, i), "$", typ)
        cols.append((value if convert else F.when(_has_type(F.get(arr, i), typ), value)).alias(name))
    return df.select(*cols)
