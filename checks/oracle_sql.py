"""DuckDB oracle SQL for every registered query (see ``__spark_entry__``).

The fixture views of FIXTURES.md are inlined as CTEs over the driver's
pre-registered tables. Averages are rounded to 6 places on both sides (float
sums depend on the order of addition).
"""

from __future__ import annotations

LO = "2024-01-05 00:00:00"
HI = "2024-01-20 12:00:00"

STATES = """
states AS (
 SELECT concat('a', lpad(CAST(e.user_id AS VARCHAR), 5, '0')) AS icao24,
  CASE WHEN e.event_id % 53 = 0 THEN NULL ELSE concat('FL', CAST(e.user_id % 40 AS VARCHAR)) END AS callsign,
  n.n_name AS origin_country,
  CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE date_trunc('hour', e.ts) END AS time_position,
  e.ts AS last_contact,
  CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_id % 89 = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(e.event_id * 53 % 36001 - 18000 AS DOUBLE) / CAST(100 AS DOUBLE) END AS longitude,
  CASE WHEN e.event_id % 89 = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(e.event_id * 37 % 18001 - 9000 AS DOUBLE) / CAST(100 AS DOUBLE) END AS latitude,
  e.value * 29 AS baro_altitude,
  CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE e.value * 30 - 1500 END AS geo_altitude,
  CASE WHEN e.event_type = 'signup' THEN true WHEN e.event_type = 'error' THEN NULL ELSE false END AS on_ground,
  CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE e.value END AS velocity,
  CAST(e.event_id % 360 AS DOUBLE) AS true_track,
  CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE CAST(e.event_id % 41 - 20 AS DOUBLE) END AS vertical_rate,
  CAST(e.event_id % 7777 AS VARCHAR) AS squawk,
  e.event_id % 29 = 0 AS spi,
  CAST(e.event_id % 4 AS VARCHAR) AS position_source,
  CAST(NULL AS DOUBLE) AS category,
  e.event_id AS seq
 FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
)"""

FACT = """
fact AS (
 SELECT time_position AS fk_temps, icao24 AS fk_aeronef,
  CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) AS fk_position,
  origin_country AS fk_pays,
  baro_altitude, geo_altitude, velocity, vertical_rate, true_track, on_ground, spi,
  position_source, last_contact
 FROM states
 WHERE time_position IS NOT NULL AND icao24 IS NOT NULL AND latitude IS NOT NULL
   AND longitude IS NOT NULL AND origin_country IS NOT NULL
)"""

DIMS = """
dim_pays AS (
 SELECT DISTINCT origin_country AS pk_pays, origin_country AS nom_pays
 FROM states WHERE origin_country IS NOT NULL
),
dim_vol AS (
 SELECT pk_vol, callsign, on_ground, squawk FROM (
  SELECT callsign AS pk_vol, callsign, on_ground, squawk,
   ROW_NUMBER() OVER (PARTITION BY callsign ORDER BY time_position DESC NULLS LAST,
     last_contact DESC NULLS LAST, callsign ASC NULLS LAST, on_ground ASC NULLS LAST,
     squawk ASC NULLS LAST) AS rn
  FROM states WHERE callsign IS NOT NULL) WHERE rn = 1
),
dim_temps AS (
 SELECT DISTINCT time_position AS pk_temps, CAST(time_position AS DATE) AS date_capture,
  time_position AS heure_capture, CAST(year(time_position) AS INTEGER) AS annee_capture,
  CAST(month(time_position) AS INTEGER) AS mois_capture, strftime(time_position, '%A') AS jour_capture
 FROM states WHERE time_position IS NOT NULL
),
dim_aeronef AS (
 SELECT pk_aeronef, category FROM (
  SELECT icao24 AS pk_aeronef, category,
   ROW_NUMBER() OVER (PARTITION BY icao24 ORDER BY time_position DESC NULLS LAST,
     last_contact DESC NULLS LAST, category ASC NULLS LAST) AS rn
  FROM states WHERE icao24 IS NOT NULL) WHERE rn = 1
),
dim_position AS (
 SELECT pk_position, latitude, longitude, geo_altitude, on_ground, position_source FROM (
  SELECT CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) AS pk_position,
   latitude, longitude, geo_altitude, on_ground, position_source,
   ROW_NUMBER() OVER (PARTITION BY CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR)
     ORDER BY time_position DESC NULLS LAST, last_contact DESC NULLS LAST,
     latitude ASC NULLS LAST, longitude ASC NULLS LAST, geo_altitude ASC NULLS LAST,
     on_ground ASC NULLS LAST, position_source ASC NULLS LAST) AS rn
  FROM states WHERE latitude IS NOT NULL AND longitude IS NOT NULL) WHERE rn = 1
)"""

WINDOW = f"""
win AS (
 SELECT * FROM fact WHERE fk_temps BETWEEN TIMESTAMP '{LO}' AND TIMESTAMP '{HI}'
),
last_ts AS (SELECT max(fk_temps) AS ts FROM win),
latest AS (SELECT win.* FROM win JOIN last_ts ON win.fk_temps = last_ts.ts)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


STAR = _with(STATES, FACT, DIMS, WINDOW)

Q = {}

Q["state_mapping"] = _with(STATES) + """
SELECT date_trunc('second', time_position) AS time_position, icao24, callsign, origin_country,
 longitude, latitude, baro_altitude, geo_altitude, velocity, vertical_rate, true_track,
 on_ground, spi, position_source, squawk, category,
 date_trunc('second', last_contact) AS last_contact
FROM states"""

# Every state becomes a message (a JSON object unless it was replaced by an
# array or by text); the quarantine keeps the ones that are not objects.
Q["state_quarantine"] = _with(STATES) + """
SELECT raw FROM (
 SELECT CASE WHEN seq % 47 = 0 THEN '["' || icao24 || '",' || CAST(seq AS VARCHAR) || ']'
             WHEN seq % 83 = 0 THEN 'not json ' || CAST(seq AS VARCHAR)
             ELSE '{"icao24":"' || icao24 || '"}' END AS raw
 FROM states)
WHERE NOT starts_with(raw, '{')"""

Q["dim_country"] = STAR + "SELECT * FROM dim_pays"
Q["dim_flight"] = STAR + "SELECT * FROM dim_vol"
Q["dim_time"] = STAR + "SELECT * FROM dim_temps"
Q["dim_aircraft"] = STAR + "SELECT * FROM dim_aeronef"
Q["dim_position"] = STAR + "SELECT * FROM dim_position"
Q["fact_state"] = STAR + "SELECT * FROM fact"

# The rows of the last reading, by their ground flag (unknown counts as in the air).
_LAST_ROWS = """
sides AS (
 SELECT on_ground IS TRUE AS down, count(fk_aeronef) AS n, avg(velocity) AS speed, avg(geo_altitude) AS height
 FROM fact WHERE fk_temps = (SELECT ts FROM last_ts) GROUP BY down)"""
LAST = STAR.rstrip() + "," + _LAST_ROWS + "\n"

Q["fleet_status"] = LAST + """
SELECT if(down, 'au sol', 'en vol') AS etat, n AS "Nb avions", round(speed * 3.6, 6) AS "Vitesse moyenne (km/h)",
 round(height, 6) AS "Altitude géo moyenne (m)" FROM sides"""

# The dimensions hold every key of the fact, so "has a row in all three" is read
# off the states themselves; a position counts where both coordinates are set and not 0.
Q["live_map"] = STAR + """
SELECT w.fk_aeronef AS aeronef_id, p.latitude, p.longitude, w.fk_pays AS pays,
 w.fk_temps AS dernier_temps, w.geo_altitude AS altitude_geo,
 if(w.on_ground IS TRUE, 'au sol', 'en vol') AS etat_sol
FROM win w, dim_position p
WHERE p.pk_position = w.fk_position AND abs(p.latitude) > 0 AND abs(p.longitude) > 0
QUALIFY row_number() OVER (PARTITION BY w.fk_aeronef ORDER BY w.fk_temps DESC NULLS LAST,
  w.last_contact DESC NULLS LAST, w.fk_position NULLS LAST, w.fk_pays NULLS LAST,
  w.on_ground NULLS LAST, w.geo_altitude NULLS LAST) = 1"""

_KNOWN = """
 FROM win
 WHERE EXISTS (FROM states s WHERE s.icao24 = win.fk_aeronef)
   AND EXISTS (FROM states s WHERE s.origin_country = win.fk_pays)
   AND EXISTS (FROM dim_position d WHERE d.pk_position = win.fk_position)
 GROUP BY fk_temps"""

Q["status_over_time"] = STAR + """
SELECT fk_temps AS timestamp, count(*) FILTER (on_ground IS NOT TRUE) AS en_vol,
 count(*) FILTER (on_ground IS TRUE) AS au_sol""" + _KNOWN

Q["status_share"] = LAST + """
SELECT if(down, 'au sol', 'en vol') AS etat, n AS nb_avions, n / (SELECT sum(n) FROM sides) AS share FROM sides"""

Q["top_countries"] = STAR + """
SELECT fk_pays, COUNT(DISTINCT fk_aeronef) AS nb_aeronefs
FROM win GROUP BY fk_pays ORDER BY nb_aeronefs DESC, fk_pays ASC LIMIT 10"""

Q["vertical_over_time"] = STAR + """
SELECT fk_temps AS timestamp, count(*) FILTER (on_ground IS NOT TRUE AND vertical_rate > 0) AS en_montee,
 count(*) FILTER (on_ground IS NOT TRUE AND vertical_rate < 0) AS en_descente""" + _KNOWN

# 500 m bands by whole metres, both toward zero; rows without altitude are a band.
Q["altitude_bands"] = STAR + """
SELECT m - m % 500 AS altitude_bucket, count(DISTINCT fk_aeronef) AS nb_avions_uniques
FROM (SELECT fk_aeronef, CAST(round_even(geo_altitude, 0) AS BIGINT) AS m FROM fact
      WHERE fk_temps = (SELECT ts FROM last_ts) AND on_ground IS NOT TRUE)
GROUP BY 1 ORDER BY 1 NULLS LAST"""

Q["country_options"] = STAR + """
SELECT 'All' AS nom_pays UNION SELECT DISTINCT nom_pays FROM dim_pays ORDER BY nom_pays"""

Q["status_last_non_null"] = STAR + """
SELECT fk_aeronef,
 max(CASE WHEN ra = 1 THEN geo_altitude END) AS geo_altitude,
 max(CASE WHEN rv = 1 THEN velocity END) AS velocity
FROM (
 SELECT fk_aeronef, geo_altitude, velocity,
  CASE WHEN geo_altitude IS NULL THEN NULL ELSE ROW_NUMBER() OVER (PARTITION BY fk_aeronef,
    geo_altitude IS NULL ORDER BY fk_temps DESC, last_contact DESC, fk_position DESC) END AS ra,
  CASE WHEN velocity IS NULL THEN NULL ELSE ROW_NUMBER() OVER (PARTITION BY fk_aeronef,
    velocity IS NULL ORDER BY fk_temps DESC, last_contact DESC, fk_position DESC) END AS rv
 FROM win)
GROUP BY fk_aeronef"""

Q["status_series_points"] = STAR + """
SELECT count(DISTINCT fk_temps) AS en_vol, count(DISTINCT fk_temps) AS au_sol FROM win"""

Q["country_filter"] = STAR + """
SELECT * FROM win WHERE fk_pays = 'NATION_7'"""

Q["adhoc_filter"] = STAR + """
SELECT * FROM win WHERE fk_pays <> 'NATION_3' AND geo_altitude >= 1000.0 AND regexp_matches(fk_pays, '^NATION_1[0-9]$')"""


def oracle_sql() -> dict[str, str]:
    return dict(Q)


# --- airports ---------------------------------------------------------------

ITEMS = """
items AS (
 SELECT c.c_custkey AS seq,
  CASE c.c_custkey % 10 WHEN 0 THEN 'airports' WHEN 1 THEN 'reportingpoints' WHEN 2 THEN 'airspaces'
   WHEN 3 THEN 'hotspots' WHEN 4 THEN 'navaids' WHEN 5 THEN 'hangglidings' WHEN 6 THEN 'obstacles'
   WHEN 7 THEN 'airfields' WHEN 8 THEN 'elsewhere' ELSE NULL END AS source_data,
  CASE WHEN c.c_custkey % 31 = 0 THEN NULL ELSE concat('  ', c.c_name, ' ') END AS name,
  n.n_name AS country,
  CASE WHEN c.c_custkey % 37 = 0 THEN NULL
       ELSE concat(substr('KESZYLA', CAST(c.c_custkey % 7 + 1 AS INT), 1),
                   lpad(CAST(c.c_custkey % 1000 AS VARCHAR), 3, '0')) END AS icao,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE lpad(CAST(c.c_custkey % 1000 AS VARCHAR), 3, 'X') END AS iata,
  CASE WHEN c.c_custkey % 43 = 0 THEN NULL
       ELSE CAST(c.c_custkey * 53 % 36001 - 18000 AS DOUBLE) / CAST(100 AS DOUBLE) END AS longitude,
  CASE WHEN c.c_custkey % 43 = 0 OR c.c_custkey % 41 = 0 THEN NULL
       ELSE CAST(c.c_custkey * 37 % 18001 - 9000 AS DOUBLE) / CAST(100 AS DOUBLE) END AS latitude
 FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

ENRICHED = """
filled AS (
 SELECT COALESCE(name, 'N/A') AS name, COALESCE(icao, 'N/A') AS icao, COALESCE(iata, 'N/A') AS iata,
  COALESCE(country, 'N/A') AS country, longitude, latitude, source_data
 FROM items
),
enriched AS (
 SELECT name, icao, iata, country, longitude, latitude, source_data,
  CASE WHEN abs(latitude) < 10 THEN 50 WHEN abs(latitude) < 30 THEN 150
       WHEN abs(latitude) < 50 THEN 300 ELSE 500 END AS altitude_estimee_m,
  CAST(trunc(longitude / CAST(15 AS DOUBLE)) AS INTEGER) AS timezone_approx,
  CASE WHEN abs(latitude) < 10 THEN 'Tropical' WHEN abs(latitude) < 30 THEN 'Aride'
       WHEN abs(latitude) < 50 THEN 'Tempéré' ELSE 'Polaire' END AS climat,
  CASE WHEN starts_with(icao, 'K') THEN 'North America' WHEN starts_with(icao, 'E') THEN 'Europe'
       WHEN starts_with(icao, 'S') THEN 'South America' WHEN starts_with(icao, 'Z') THEN 'Asia'
       WHEN starts_with(icao, 'Y') THEN 'Oceania' ELSE 'Unknown' END AS airport_category,
  trim(name) AS name_clean, upper(name) AS name_upper,
  CAST(0 AS BIGINT) AS processing_delay_s,
  abs(latitude) / 90 + abs(longitude) / 180 AS geo_score
 FROM filled
)"""

AIR = _with(ITEMS, ENRICHED)
_ALL_ENRICHED = ("name, icao, iata, country, longitude, latitude, source_data, altitude_estimee_m, "
                 "timezone_approx, climat, airport_category, name_clean, name_upper, "
                 "processing_delay_s, geo_score")


def _order_all(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS LAST" for c in cols.split(","))


Q["airport_enrich"] = AIR + f"SELECT {_ALL_ENRICHED} FROM enriched"

Q["airport_route_counts"] = AIR + """
SELECT CASE WHEN source_data IN ('airports', 'reportingpoints', 'airspaces', 'hotspots', 'navaids',
  'hangglidings', 'obstacles', 'airfields') THEN source_data ELSE '__unrouted__' END AS target,
 COUNT(*) AS n_rows
FROM enriched GROUP BY 1"""

Q["airfield_preview"] = AIR + f"""
SELECT {_ALL_ENRICHED} FROM enriched WHERE source_data = 'airfields'
ORDER BY {_order_all(_ALL_ENRICHED)} LIMIT 50"""

Q["hotspot_geo_score"] = AIR + """
SELECT round(AVG(geo_score), 6) AS avg FROM enriched WHERE source_data = 'hotspots'"""

_TABLE_COLS = "name, country, longitude, latitude, altitude_estimee_m, climat, geo_score, source_data"
Q["airfield_table"] = AIR + f"""
SELECT {_TABLE_COLS} FROM enriched WHERE source_data = 'airfields'
ORDER BY {_order_all(_TABLE_COLS)} LIMIT 50"""

Q["country_altitude"] = AIR + """
SELECT country, altitude_estimee_m FROM enriched WHERE source_data = 'airports'
ORDER BY country ASC NULLS LAST, altitude_estimee_m ASC NULLS LAST LIMIT 50"""


# --- snapshots --------------------------------------------------------------

SNAPS = """
snap_rows AS (
 SELECT *, date_trunc('hour', last_contact) AS snap,
  ROW_NUMBER() OVER (PARTITION BY date_trunc('hour', last_contact), icao24
                     ORDER BY last_contact DESC, seq DESC) AS rk
 FROM states
),
snaps AS (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY snap ORDER BY icao24) - 1 AS pos
 FROM snap_rows WHERE rk = 1
)"""

def _num(f: str, steps: int = 1, cast: str = "") -> str:
    """SQL for ``steps`` rounds of ``x = (x - p) + x`` when both are set."""
    c, p = (f"CAST(c.{f} AS {cast})", f"CAST(p.{f} AS {cast})") if cast else (f"c.{f}", f"p.{f}")
    x = c
    for _ in range(steps):
        x = f"(({x}) - {p}) + ({x})"
    return f"CASE WHEN p.{f} IS NOT NULL AND c.{f} IS NOT NULL THEN {x} ELSE {c} END"


def _ground(steps: int = 1) -> str:
    """Position 8: arithmetic on 0/1 then coerced to boolean, every round."""
    x = "c.on_ground"
    for _ in range(steps):
        x = (f"COALESCE(CASE WHEN p.on_ground IS NOT NULL AND ({x}) IS NOT NULL THEN "
             f"(CAST({x} AS INTEGER) - CAST(p.on_ground AS INTEGER)) + CAST({x} AS INTEGER) <> 0 "
             f"ELSE {x} END, false)")
    return x


def _extrapolated(join: str, steps: int = 1) -> str:
    t = "CAST(epoch(c.snap) AS BIGINT) + 30"
    return _with(STATES, SNAPS) + f"""
SELECT c.snap, {t} AS time, CAST(c.pos AS INTEGER) AS pos,
 c.icao24, c.callsign, c.origin_country, {t} AS time_position, {t} AS last_contact,
 {_num("longitude", steps)} AS longitude,
 {_num("latitude", steps)} AS latitude,
 {_num("baro_altitude", steps)} AS baro_altitude,
 {_ground(steps)} AS on_ground,
 {_num("velocity", steps)} AS velocity,
 {_num("true_track", steps)} AS true_track,
 {_num("vertical_rate", steps)} AS vertical_rate,
 CAST(NULL AS INTEGER[]) AS sensors,
 {_num("geo_altitude", steps)} AS geo_altitude,
 c.squawk,
 CAST({_num("spi", steps, "INTEGER")} AS BIGINT) AS spi,
 CAST({_num("position_source", steps, "BIGINT")} AS BIGINT) AS position_source
FROM snaps c LEFT JOIN snaps p ON p.snap + INTERVAL 1 HOUR = c.snap AND {join}"""


Q["snapshot_extrapolate"] = _extrapolated("p.pos = c.pos")
Q["snapshot_extrapolate_by_key"] = _extrapolated("p.icao24 = c.icao24")
Q["snapshot_extrapolate_steps"] = _extrapolated("p.pos = c.pos", steps=3)

Q["snapshot_split"] = _with(STATES, SNAPS) + """
SELECT CAST(epoch(snap) AS BIGINT) AS time, CAST(pos % 50 AS INTEGER) AS pos,
 icao24, callsign, origin_country,
 CAST(floor(epoch(time_position)) AS BIGINT) AS time_position,
 CAST(floor(epoch(last_contact)) AS BIGINT) AS last_contact,
 longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate,
 CAST(NULL AS INTEGER[]) AS sensors, geo_altitude, squawk, spi,
 CAST(position_source AS BIGINT) AS position_source, CAST(NULL AS BIGINT) AS category
FROM snaps"""

# Upsert of two batches split in time = the latest row per key over both.
Q["upsert_two_batches"] = STAR + "SELECT * FROM dim_position"

# The fact loaded through the file stream equals the batch fact, with
# ``last_contact`` at whole seconds (messages carry epoch seconds).
_STORED_FACT = """
SELECT fk_temps, fk_aeronef, fk_position, fk_pays, baro_altitude, geo_altitude, velocity,
 vertical_rate, true_track, on_ground, spi, position_source,
 date_trunc('second', last_contact) AS last_contact
FROM fact"""
Q["fact_state_stream"] = STAR + _STORED_FACT

Q["fact_two_streams"] = Q["fact_state_stream"]

Q["snapshot_star_stream"] = _with(STATES, SNAPS) + """
SELECT time_position AS fk_temps, icao24 AS fk_aeronef,
 CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) AS fk_position, origin_country AS fk_pays,
 baro_altitude, geo_altitude, velocity, vertical_rate, true_track, on_ground, spi, position_source,
 date_trunc('second', last_contact) AS last_contact
FROM snaps WHERE time_position IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""

Q["airport_routed_stored"] = AIR + f"""
SELECT {_ALL_ENRICHED} FROM enriched
WHERE source_data IS NOT NULL AND source_data <> 'elsewhere'"""

# The batch number orders the loads; inside a batch the latest row of a key wins.
_BATCHED = STATES.replace("e.ts AS last_contact", "date_trunc('second', e.ts) AS last_contact") + """,
loads AS (
 SELECT *, CASE WHEN callsign IS NULL AND time_position < TIMESTAMP '2024-01-08 00:00:00' THEN 0
   WHEN time_position >= TIMESTAMP '2024-01-15 00:00:00' THEN 2 ELSE 1 END AS b,
  CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) AS place
 FROM states)"""
_WINS = "ORDER BY b DESC, time_position DESC NULLS LAST, last_contact DESC NULLS LAST"
Q["upsert_stored_batches"] = _with(_BATCHED) + f"""
SELECT DISTINCT 'dim_pays' AS dim, origin_country AS pk, CAST(NULL AS BOOLEAN) AS on_ground, CAST(NULL AS VARCHAR) AS txt,
 CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS position_source FROM loads
UNION ALL SELECT DISTINCT 'dim_temps', strftime(time_position, '%Y-%m-%d %H:%M:%S'), NULL, strftime(time_position, '%A'), NULL, NULL
 FROM loads WHERE time_position IS NOT NULL
UNION ALL SELECT DISTINCT 'dim_aeronef', icao24, NULL, NULL, NULL, NULL FROM loads
UNION ALL (SELECT 'dim_vol', callsign, on_ground, squawk, NULL, NULL FROM loads WHERE callsign IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY callsign {_WINS}, on_ground NULLS LAST, squawk NULLS LAST) = 1)
UNION ALL (SELECT 'dim_position', place, on_ground, NULL, geo_altitude, position_source FROM loads WHERE place IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY place {_WINS}, geo_altitude NULLS LAST, on_ground NULLS LAST,
   position_source NULLS LAST) = 1)"""

Q["time_range_other_zone"] = STAR + """
SELECT fk_aeronef, fk_position, CAST(epoch(fk_temps) AS BIGINT) AS t FROM fact
WHERE fk_temps BETWEEN TIMESTAMP '2024-01-05 23:30:00' AND TIMESTAMP '2024-01-08 00:30:00'"""

Q["adhoc_filter_numeric"] = AIR + """
SELECT name, icao, source_data, latitude, altitude_estimee_m, timezone_approx FROM enriched
WHERE altitude_estimee_m IN (150, 300) AND timezone_approx >= -3"""

Q["positional_wrong_types"] = """
SELECT event_id AS time, CAST(0 AS INTEGER) AS pos, if(event_id % 3 = 0, NULL, 's' || event_id) AS a,
 if(event_id % 4 = 3, event_id, NULL) AS b, if(event_id % 2 = 0, NULL, CAST(event_id AS DOUBLE) + 0.5) AS c,
 if(event_id % 5 >= 3, true, NULL) AS d, CAST(NULL AS VARCHAR) AS e FROM events
UNION ALL SELECT event_id, 1, NULL, NULL, NULL, NULL, NULL FROM events"""

Q["state_mapping_binary"] = Q["state_mapping"]
Q["airport_ingestion_time"] = AIR + "SELECT true AS stamped, count(*) AS n_rows FROM enriched"
for _name in ("fleet_status", "status_share", "altitude_bands", "live_map", "status_over_time", "vertical_over_time"):
    Q[f"{_name}_stored"] = Q[_name]
for _name, _by in (("status_over_time", "timestamp"), ("vertical_over_time", "timestamp"),
                   ("altitude_bands", "altitude_bucket NULLS LAST"), ("country_options", "nom_pays")):
    Q[f"{_name}_order"] = f"SELECT *, row_number() OVER (ORDER BY {_by}) - 1 AS position FROM ({Q[_name]})"

Q["upsert_folded_batches"] = Q["upsert_stored_batches"]
Q["fact_closed_days"] = Q["fact_state_stream"]
Q["airport_routed_folded"] = Q["airport_routed_stored"]
Q["fact_stream_restart"] = STAR + f"SELECT *, (SELECT count(*) FROM states) AS messages FROM ({_STORED_FACT})"

# Pages of ten customers a source; every second, third and fourth of five is broken.
Q["airport_quarantine"] = _with(ITEMS) + """
SELECT CASE page % 5 WHEN 1 THEN 'not json ' || source || page
  WHEN 2 THEN '["' || source || '",' || page || ']'
  ELSE '{"source_data":"' || source || '","page":' || page || ',"items":[]}' END AS raw
FROM (SELECT DISTINCT coalesce(source_data, 'none') AS source, seq // 100 AS page FROM items)
WHERE page % 5 IN (1, 2, 3)"""

Q["batch_metrics"] = _with(STATES).rstrip() + """,
loads AS (SELECT *, if(seq % 3 = 0, 0, 2) AS b, latitude IS NOT NULL AND longitude IS NOT NULL AS placed FROM states),
counts AS (
 SELECT CAST(b AS BIGINT) AS batch_id, count(DISTINCT origin_country) AS dim_pays, count(DISTINCT callsign) AS dim_vol,
  count(DISTINCT time_position) AS dim_temps, count(DISTINCT icao24) AS dim_aeronef,
  count(DISTINCT (latitude, longitude)) FILTER (placed) AS dim_position,
  count(*) FILTER (placed AND time_position IS NOT NULL) AS fait_etat_vol
 FROM loads GROUP BY b)
SELECT batch_id, target, n_rows FROM counts
UNPIVOT (n_rows FOR target IN (dim_pays, dim_vol, dim_temps, dim_aeronef, dim_position, fait_etat_vol))"""

Q["snapshot_files"] = Q["snapshot_split"]


def _far(f: str, cast: str = "DOUBLE") -> str:
    """16 rounds of ``x = (x - p) + x`` at once."""
    c, p = f"CAST(c.{f} AS {cast})", f"CAST(p.{f} AS {cast})"
    return f"coalesce({c} + CAST(65535 AS {cast}) * ({c} - {p}), {c})"


_T30 = "CAST(epoch(c.snap) AS BIGINT) + 30"
Q["snapshot_extrapolate_steps16"] = _with(STATES, SNAPS) + f"""
SELECT c.snap, {_T30} AS time, CAST(c.pos AS INTEGER) AS pos, c.icao24, c.callsign, c.origin_country,
 {_T30} AS time_position, {_T30} AS last_contact,
 {", ".join(f"{_far(f)} AS {f}" for f in ("longitude", "latitude", "baro_altitude", "velocity", "true_track",
                                           "vertical_rate", "geo_altitude"))},
 {_ground(2)} AS on_ground, CAST(NULL AS INTEGER[]) AS sensors, c.squawk,
 {_far("spi", "BIGINT")} AS spi, {_far("position_source", "BIGINT")} AS position_source
FROM snaps c LEFT JOIN snaps p ON p.snap + INTERVAL 1 HOUR = c.snap AND p.pos = c.pos"""

Q["snapshot_documents_back"] = f"SELECT * EXCLUDE (snap) FROM ({Q['snapshot_extrapolate']})"

Q["snapshot_table_pair"] = _with(STATES, SNAPS).rstrip() + """,
ends AS (SELECT DISTINCT snap FROM snaps ORDER BY snap DESC LIMIT 2)
SELECT CAST(epoch(c.snap) AS BIGINT) AS time, CAST(c.pos AS INTEGER) AS pos, c.icao24, p.icao24 AS previous_icao24
FROM snaps c LEFT JOIN snaps p ON p.pos = c.pos AND p.snap = (SELECT min(snap) FROM ends)
WHERE c.snap = (SELECT max(snap) FROM ends)"""
