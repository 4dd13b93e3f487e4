"""Fixed, hand-declared schemas and names (nothing is inferred).

Fixed values: the field names and types below must equal the feed's
message layout and the star-schema column names for results to match.
"""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType,
)

# One flight-state message, a flat JSON object.
FLIGHT_STATE_SCHEMA = StructType([
    StructField("icao24", StringType(), True),
    StructField("callsign", StringType(), True),
    StructField("origin_country", StringType(), True),
    StructField("time_position", LongType(), True),
    StructField("last_contact", LongType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("baro_altitude", DoubleType(), True),
    StructField("on_ground", BooleanType(), True),
    StructField("velocity", DoubleType(), True),
    StructField("true_track", DoubleType(), True),
    StructField("vertical_rate", DoubleType(), True),
    StructField("geo_altitude", DoubleType(), True),
    StructField("squawk", StringType(), True),
    StructField("spi", BooleanType(), True),
    StructField("position_source", LongType(), True),
    StructField("category", DoubleType(), True),
])

# Airport envelope (page header + items + source name).
GEOMETRY_SCHEMA = StructType([
    StructField("type", StringType(), True),
    StructField("coordinates", ArrayType(DoubleType()), True),
])
AIRPORT_ITEM_SCHEMA = StructType([
    StructField("name", StringType(), True),
    StructField("country", StringType(), True),
    StructField("icaoCode", StringType(), True),
    StructField("iataCode", StringType(), True),
    StructField("geometry", GEOMETRY_SCHEMA, True),
])
AIRPORT_ENVELOPE_SCHEMA = StructType([
    StructField("limit", IntegerType(), True),
    StructField("totalCount", IntegerType(), True),
    StructField("totalPages", IntegerType(), True),
    StructField("page", IntegerType(), True),
    StructField("items", ArrayType(AIRPORT_ITEM_SCHEMA), True),
    StructField("source_data", StringType(), True),
])

# The eight airport tables, in this order.
AIRPORT_SOURCES = ["airports", "reportingpoints", "airspaces", "hotspots",
                   "navaids", "hangglidings", "obstacles", "airfields"]

# Snapshot document {"time": epoch, "states": [[positional values], ...]}.
SNAPSHOT_DDL = "time bigint, states array<array<variant>>"

# Positional layout of a state vector in a snapshot document
# (index -> name, type). Index 12 is the sensor id list.
SNAPSHOT_FIELDS = [
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"),
    ("time_position", "bigint"), ("last_contact", "bigint"),
    ("longitude", "double"), ("latitude", "double"), ("baro_altitude", "double"),
    ("on_ground", "boolean"), ("velocity", "double"), ("true_track", "double"),
    ("vertical_rate", "double"), ("sensors", "array<int>"),
    ("geo_altitude", "double"), ("squawk", "string"), ("spi", "boolean"),
    ("position_source", "bigint"), ("category", "bigint"),
]

# Star-schema column lists (recovered from the insert statements).
DIM_COUNTRY_COLS = ["pk_pays", "nom_pays"]
DIM_FLIGHT_COLS = ["pk_vol", "callsign", "on_ground", "squawk"]
DIM_TIME_COLS = ["pk_temps", "date_capture", "heure_capture", "annee_capture",
                 "mois_capture", "jour_capture"]
DIM_AIRCRAFT_COLS = ["pk_aeronef", "category"]
DIM_POSITION_COLS = ["pk_position", "latitude", "longitude", "geo_altitude",
                     "on_ground", "position_source"]
FACT_COLS = ["fk_temps", "fk_aeronef", "fk_position", "fk_pays", "baro_altitude",
             "geo_altitude", "velocity", "vertical_rate", "true_track", "on_ground",
             "spi", "position_source", "last_contact"]
FACT_KEYS = ["fk_temps", "fk_aeronef", "fk_position", "fk_pays"]

# Dashboard labels.
IN_AIR = "en vol"
ON_GROUND = "au sol"
