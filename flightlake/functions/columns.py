"""Scalar column expressions. All built-in, JVM-side, codegen'd.

Every helper takes and returns ``Column`` so it can be used in ``select``,
``withColumns``, ``filter`` and ``groupBy`` alike, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightlake.schemas import IN_AIR, ON_GROUND


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys (X1, X2) ---------------------------------------------------------

def position_key(lat="latitude", lon="longitude") -> Column:
    """``"<lat>_<lon>"``; null when either side is null (``concat``, not ``concat_ws``)."""
    return F.concat(_c(lat).cast("string"), F.lit("_"), _c(lon).cast("string"))


def state_key(callsign="callsign", ts="time_position", lat="latitude",
              lon="longitude") -> Column:
    """``callsign_time_lat_lon``; null when the callsign is null."""
    return F.concat(_c(callsign), F.lit("_"), _c(ts).cast("string"), F.lit("_"),
                    _c(lat).cast("string"), F.lit("_"), _c(lon).cast("string"))


# --- time (X11-X16) --------------------------------------------------------

def epoch_to_timestamp(c) -> Column:
    """Epoch seconds -> TIMESTAMP, with no detour through a zone-dependent string."""
    return F.timestamp_seconds(_c(c))


def time_parts(ts="time_position") -> dict[str, Column]:
    """The time dimension's derived columns (date, full timestamp, year, month, weekday)."""
    t = _c(ts)
    return {
        "date_capture": F.to_date(t),
        "heure_capture": t,
        "annee_capture": F.year(t),
        "mois_capture": F.month(t),
        "jour_capture": F.date_format(t, "EEEE"),
    }


def utc_day(ts) -> Column:
    """UTC date of a TIMESTAMP, the same in every session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(_c(ts)) / F.lit(86_400_000_000)).cast("int"))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (both TIMESTAMP)."""
    return F.unix_seconds(_c(end)) - F.unix_seconds(_c(start))


# --- flight status (X17-X21) -------------------------------------------------

def on_ground_or_false(c="on_ground") -> Column:
    return F.coalesce(_c(c), F.lit(False))


def status_label(on_ground="on_ground", null_is_air: bool = True) -> Column:
    """'en vol' / 'au sol'.

    ``null_is_air=True`` reads an unknown ground flag as airborne
    (``CASE WHEN on_ground = FALSE ... ELSE`` after ``COALESCE(.., false)``).
    """
    g = on_ground_or_false(on_ground) if null_is_air else _c(on_ground)
    return F.when(~g, F.lit(IN_AIR)).otherwise(F.lit(ON_GROUND))


def kmh(ms) -> Column:
    """m/s -> km/h."""
    return _c(ms) * F.lit(3.6)


def round_half_even_int(c) -> Column:
    """SQL ``CAST(double AS INTEGER)`` as a rounding cast (half to even).

    Spark's cast truncates, so round first with ``rint``. Out-of-range values
    become null instead of failing the query.
    """
    return F.rint(_c(c)).try_cast("int")


def fixed_band(c, width: int = 500) -> Column:
    """Lower edge of a ``width`` band using integer division that truncates
    toward zero (``a - a % w`` == ``(a div w) * w``), so -499..499 all land in
    band 0. BIGINT; null stays null."""
    a = _c(c).cast("bigint")
    return a - a % F.lit(int(width)).cast("bigint")


def non_zero(c) -> Column:
    """Boolean coercion of a number: null -> false, non-zero -> true."""
    return F.coalesce(_c(c) != F.lit(0), F.lit(False))


# --- airport enrichment (X3-X10) ---------------------------------------------

# Latitude bands (|lat| < 10, < 30, < 50, else) -> estimated
# altitude in m and climate label.
LAT_BAND_LIMITS = [10, 30, 50]
LAT_BAND_ALTITUDES = [50, 150, 300, 500]
LAT_BAND_CLIMATES = ["Tropical", "Aride", "Tempéré", "Polaire"]

# First letter of an ICAO code -> region; anything else "Unknown".
ICAO_REGIONS = [("K", "North America"), ("E", "Europe"), ("S", "South America"),
                ("Z", "Asia"), ("Y", "Oceania")]
UNKNOWN_REGION = "Unknown"


def _lat_band(lat, values) -> Column:
    a = F.abs(_c(lat))
    expr = None
    for limit, v in zip(LAT_BAND_LIMITS, values):
        expr = (F.when(a < limit, F.lit(v)) if expr is None
                else expr.when(a < limit, F.lit(v)))
    # A null latitude falls through to the last band.
    return expr.otherwise(F.lit(values[-1]))


def altitude_estimate(lat="latitude") -> Column:
    return _lat_band(lat, LAT_BAND_ALTITUDES)


def climate(lat="latitude") -> Column:
    return _lat_band(lat, LAT_BAND_CLIMATES)


def timezone_approx(lon="longitude") -> Column:
    """Longitude / 15, truncated toward zero to INT (null-safe under ANSI)."""
    return (_c(lon) / F.lit(15)).try_cast("int")


def icao_region(icao="icao") -> Column:
    expr = None
    for prefix, region in ICAO_REGIONS:
        cond = _c(icao).startswith(prefix)
        expr = F.when(cond, F.lit(region)) if expr is None else expr.when(cond, F.lit(region))
    return expr.otherwise(F.lit(UNKNOWN_REGION))


def geo_score(lat="latitude", lon="longitude") -> Column:
    return F.abs(_c(lat)) / F.lit(90) + F.abs(_c(lon)) / F.lit(180)
