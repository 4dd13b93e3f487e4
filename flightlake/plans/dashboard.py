"""Fleet dashboard queries (Q1-Q8) and panel reducers.

Each query is a function of the star tables and an inclusive time range
``(lo, hi)``; either bound may be ``None``. They are ordinary lazy DataFrames:
no SQL text is built and nothing is collected.

Plan notes (100 TB scale):
* the time range is pushed into the fact scan, and prunes ``day``
  partitions when the fact has them;
* "rows at the last reading" compares against a scalar subquery (the max of
  one pruned column), so no join and no broadcast is involved;
* the last reading comes from the stored reading times where they are given
  (``times``), so that the fact is read once, and only that day;
* a warehouse that records that its fact keys hold needs no dimension join
  (``star_load.dashboard_tables``); else
  dimension joins that only test existence are semi joins on the key; the
  planner broadcasts a dimension only when its measured size is under the
  threshold (AQE re-checks at run time), so the position dimension, which
  grows with the fact, becomes a shuffle join at scale;
* distinct counts run as two hash aggregates (partial per task first), so a
  country holding a third of all rows is spread over the first shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.functions.columns import (
    fixed_band, kmh, on_ground_or_false, round_half_even_int, status_label,
)
from flightlake.operators.filters import (
    DAY_COL, _day_of, airborne, position_key_valid, time_range, valid_coordinates,
)
from flightlake.operators.joins import exists_in


def at_last_reading(fact: DataFrame, lo=None, hi=None, col: str = "fk_temps",
                    times: DataFrame | None = None) -> DataFrame:
    """Fact rows whose time equals the single latest time in the range (A1 + J4).

    Exact equality, like the reference: with one reading time per aircraft
    few rows match; with snapshot-stamped feeds all rows of the snapshot do.

    ``times`` holds the reading times of the whole ``fact`` (column ``col``):
    the latest one then comes from there, not from the fact. Leave it out for a
    fact that has been filtered by anything but time.
    """
    in_range = time_range(fact, col, lo, hi)
    if times is not None:
        readings = time_range(times, col, lo, hi)
    elif DAY_COL in fact.columns and hi is None:
        # The last day with rows comes first, by partition values alone.
        readings = in_range.filter(F.col(DAY_COL) == fact.agg(F.max(DAY_COL)).scalar())
    else:
        readings = in_range
    last = readings.agg(F.max(col)).scalar()
    cond = F.col(col) == last
    if DAY_COL in fact.columns:
        # Prunes the main scan to the one day partition holding that time.
        cond = cond & (F.col(DAY_COL) == _day_of(fact, col, last))
    return in_range.filter(cond)


def fleet_status(fact: DataFrame, lo=None, hi=None, times: DataFrame | None = None) -> DataFrame:
    """Q1: at the last reading, per air/ground state: aircraft rows, mean km/h,
    mean geometric altitude."""
    latest = at_last_reading(fact, lo, hi, times=times)
    return (latest.groupBy(status_label("on_ground").alias("etat"))
            .agg(F.count("fk_aeronef").alias("Nb avions"),
                 kmh(F.avg("velocity")).alias("Vitesse moyenne (km/h)"),
                 F.avg("geo_altitude").alias("Altitude géo moyenne (m)")))


LIVE_MAP_ORDER = ["fk_temps", "last_contact", "fk_position", "fk_pays", "on_ground",
                  "geo_altitude"]


def _live_map_order() -> list[Column]:
    # Latest time first; the rest only breaks ties so the pick is deterministic.
    return [F.col("fk_temps").desc_nulls_last(), F.col("last_contact").desc_nulls_last()] + \
           [F.col(c).asc_nulls_last() for c in LIVE_MAP_ORDER[2:]]


def live_map(fact: DataFrame, dim_aeronef: DataFrame | None = None, dim_position: DataFrame | None = None,
             dim_pays: DataFrame | None = None, lo=None, hi=None,
             derived_position_keys: bool = True) -> DataFrame:
    """Q2: latest state per aircraft (within the range, at a valid position)
    with its coordinates, country and air/ground label.

    ``derived_position_keys`` (true for tables built by ``operators.star``)
    applies the coordinate check to the fact's key too, before the joins.
    Without dimensions (a fact whose keys all hold, of the same builders) the
    coordinates and the country are read off the keys, and nothing is joined:
    the rows are dealt out once, by aircraft, with one row a task and aircraft.
    """
    f = time_range(fact, "fk_temps", lo, hi).select(
        "fk_aeronef", "fk_position", "fk_pays", "fk_temps", "last_contact",
        "on_ground", "geo_altitude")
    if derived_position_keys or dim_aeronef is None:
        f = f.filter(position_key_valid("fk_position"))
    if dim_aeronef is None:
        parts = F.split(F.col("fk_position"), "_")
        j = f.select("*", F.get(parts, 0).cast("double").alias("latitude"), F.get(parts, 1).cast("double").alias("longitude"),
                     F.col("fk_pays").alias("nom_pays"))
    else:
        pos = dim_position.filter(valid_coordinates()).select(
            F.col("pk_position"), "latitude", "longitude")
        pays = dim_pays.select("pk_pays", "nom_pays")
        # The aircraft check goes last, as an inner join on the key column alone:
        # when it is a shuffle join, its partitioning on fk_aeronef is the one the
        # per-aircraft window needs, so the window adds no shuffle. (A semi join
        # would be pushed below the other joins by the optimizer. A repeated key
        # could only repeat identical rows, of which rn = 1 keeps one.)
        aircraft = dim_aeronef.select(F.col("pk_aeronef"))
        j = (f.join(pos, F.col("fk_position") == F.col("pk_position"))
             .join(pays, F.col("fk_pays") == F.col("pk_pays"))
             .join(aircraft, F.col("fk_aeronef") == F.col("pk_aeronef")))
    w = Window.partitionBy("fk_aeronef").orderBy(*_live_map_order())
    latest = j.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return latest.select(
        F.col("fk_aeronef").alias("aeronef_id"),
        "latitude", "longitude",
        F.col("nom_pays").alias("pays"),
        F.col("fk_temps").alias("dernier_temps"),
        F.col("geo_altitude").alias("altitude_geo"),
        status_label("on_ground").alias("etat_sol"),
    )


def _with_dims(fact: DataFrame,
               dims: tuple[DataFrame, DataFrame, DataFrame] | None) -> DataFrame:
    if dims is None:
        return fact
    dim_aeronef, dim_position, dim_pays = dims
    f = exists_in(fact, dim_aeronef, "fk_aeronef", "pk_aeronef")
    f = exists_in(f, dim_position, "fk_position", "pk_position")
    return exists_in(f, dim_pays, "fk_pays", "pk_pays")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def status_over_time(fact: DataFrame, dims=None, lo=None, hi=None) -> DataFrame:
    """Q3: airborne / on-ground rows per reading time, ascending.

    ``dims=(dim_aeronef, dim_position, dim_pays)`` keeps only fact rows that
    have all three dimension rows (the reference's inner joins); ``None``
    skips that check.
    """
    f = _with_dims(time_range(fact, "fk_temps", lo, hi), dims)
    g = on_ground_or_false("on_ground")
    return (f.groupBy(F.col("fk_temps").alias("timestamp"))
            .agg(_count_if(~g).alias("en_vol"), _count_if(g).alias("au_sol"))
            .orderBy(F.col("timestamp").asc_nulls_last()))


def status_split(fact: DataFrame, lo=None, hi=None, times: DataFrame | None = None) -> DataFrame:
    """Q4: aircraft rows in the air / on the ground at the last reading."""
    latest = at_last_reading(fact, lo, hi, times=times)
    return (latest.groupBy(status_label("on_ground").alias("etat"))
            .agg(F.count("fk_aeronef").alias("nb_avions")))


def share_of_total(df: DataFrame, col: str, alias: str = "share") -> DataFrame:
    """Each row's share of the column total (a pie's percent).

    The total is a one-row aggregate compared through a scalar subquery, not a
    window over the whole frame (which would put every row in one task).
    """
    total = df.agg(F.sum(col)).scalar()
    # A zero total gives null instead of an ANSI division error.
    return df.withColumn(alias, F.try_divide(F.col(col).cast("double"), total))


def top_countries(fact: DataFrame, lo=None, hi=None, k: int = 10,
                  approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Q5: the ``k`` countries with the most distinct aircraft (ties by name).

    ``approximate=True`` switches to HyperLogLog++ (``approx_count_distinct``)
    for very wide ranges; never silently.
    """
    f = time_range(fact, "fk_temps", lo, hi)
    n = (F.approx_count_distinct("fk_aeronef", rsd) if approximate
         else F.count_distinct("fk_aeronef"))
    return (f.groupBy("fk_pays").agg(n.alias("nb_aeronefs"))
            .orderBy(F.col("nb_aeronefs").desc(), F.col("fk_pays").asc_nulls_last())
            .limit(k))


def vertical_over_time(fact: DataFrame, dims=None, lo=None, hi=None) -> DataFrame:
    """Q6: climbing / descending airborne rows per reading time, ascending."""
    f = _with_dims(time_range(fact, "fk_temps", lo, hi), dims)
    rate = F.coalesce(F.col("vertical_rate"), F.lit(0.0))
    air = airborne("on_ground")
    return (f.groupBy(F.col("fk_temps").alias("timestamp"))
            .agg(_count_if((rate > 0) & air).alias("en_montee"),
                 _count_if((rate < 0) & air).alias("en_descente"))
            .orderBy(F.col("timestamp").asc_nulls_last()))


def altitude_bands(fact: DataFrame, lo=None, hi=None, width: int = 500,
                   times: DataFrame | None = None) -> DataFrame:
    """Q7: distinct airborne aircraft per ``width`` m band of geometric altitude
    at the last reading. The altitude is rounded half-to-even to an integer,
    then integer-divided (toward zero); a null altitude forms its own band,
    sorted last."""
    latest = at_last_reading(fact, lo, hi, times=times).filter(airborne("on_ground"))
    band = fixed_band(round_half_even_int("geo_altitude"), width)
    return (latest.groupBy(band.alias("altitude_bucket"))
            .agg(F.count_distinct("fk_aeronef").alias("nb_avions_uniques"))
            .orderBy(F.col("altitude_bucket").asc_nulls_last()))


def country_options(dim_pays: DataFrame, all_label: str = "All") -> DataFrame:
    """Q8: 'All' plus every country name, distinct, sorted ('All' sorts among them)."""
    names = dim_pays.select("nom_pays")
    all_row = dim_pays.sparkSession.range(1).select(F.lit(all_label).alias("nom_pays"))
    return names.union(all_row).distinct().orderBy(F.col("nom_pays").asc_nulls_last())


# --- panel reducers --------------------------------------------------------

def last_not_null(df: DataFrame, group_cols: list[str], value_cols: list[str],
                  order_cols: list[str]) -> DataFrame:
    """Per group, each value column's last non-null value under
    ``order_cols`` (latest first, ties broken by the following columns).

    ``max_by`` is an aggregate with a partial phase, so a hot group is reduced
    in every task before the shuffle.
    """
    aggs = []
    for v in value_cols:
        present = F.col(v).isNotNull()
        ordering = F.when(present, F.struct(*[F.col(c) for c in order_cols]))
        aggs.append(F.max_by(F.when(present, F.col(v)), ordering).alias(v))
    return df.groupBy(*group_cols).agg(*aggs)


def series_points(df: DataFrame, series: list[str]) -> DataFrame:
    """Number of plotted (non-null) points of each series."""
    return df.agg(*[F.count(c).alias(c) for c in series])
