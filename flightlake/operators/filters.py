"""Predicates.

Filters are plain ``Column`` expressions so Catalyst pushes them into the
parquet scan (``PushedFilters``) and, on a day-partitioned fact, prunes
partitions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType

from flightlake.functions.columns import on_ground_or_false, utc_day

DAY_COL = "day"


def _typed_lit(df: DataFrame, col: str, v) -> Column:
    """Literal of the column's own type, so that the comparison needs no cast on
    the column's side (a cast there would block pushdown). A fraction against an
    integer column stays a fraction: both are then compared as DOUBLE."""
    kind = df.schema[col].dataType
    if isinstance(kind, IntegralType):
        number = v if isinstance(v, (int, float)) else float(v)
        if number != int(number):
            return F.lit(float(number))
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:  # an instant, whatever the process or session zone
            if isinstance(kind, TimestampNTZType):
                return F.lit(v.astimezone(_dt.timezone.utc).replace(tzinfo=None).isoformat()).cast(kind)
            return F.lit(v.astimezone(_dt.timezone.utc).isoformat()).cast(kind)
        v = v.isoformat(sep=" ")  # wall clock of the session zone, as text is
    return F.lit(v).cast(kind)


def _day_of(df: DataFrame, col: str, ts: Column) -> Column:
    """UTC day as stored in ``day``; a wall-clock column has only its own date."""
    return F.to_date(ts) if isinstance(df.schema[col].dataType, TimestampNTZType) else utc_day(ts)


def time_range(df: DataFrame, col: str = "fk_temps", lo=None, hi=None) -> DataFrame:
    """``lo <= col <= hi`` (either bound optional), inclusive like
    ``BETWEEN``. Adds the matching ``day`` predicate when the frame has a
    ``day`` partition column so whole days are skipped at listing time."""
    conds = []
    if lo is not None:
        conds.append(F.col(col) >= _typed_lit(df, col, lo))
    if hi is not None:
        conds.append(F.col(col) <= _typed_lit(df, col, hi))
    if DAY_COL in df.columns:
        if lo is not None:
            conds.append(F.col(DAY_COL) >= _day_of(df, col, _typed_lit(df, col, lo)))
        if hi is not None:
            conds.append(F.col(DAY_COL) <= _day_of(df, col, _typed_lit(df, col, hi)))
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def last_minutes(df: DataFrame, minutes: int = 15, col: str = "fk_temps",
                 now: _dt.datetime | None = None) -> DataFrame:
    """Dashboard default window ``now - 15m .. now``; ``now`` is zone-aware."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return time_range(df, col, now - _dt.timedelta(minutes=minutes), now)


def valid_coordinates(lat: str = "latitude", lon: str = "longitude") -> Column:
    """both set and neither exactly zero."""
    return (F.col(lat).isNotNull() & F.col(lon).isNotNull()
            & (F.col(lat) != 0) & (F.col(lon) != 0))


def position_key_valid(col: str = "fk_position") -> Column:
    """``valid_coordinates`` read off a ``"<lat>_<lon>"`` key built by
    ``position_key``: neither part is a zero. Lets the fact side drop rows
    that can never join a valid position (a hot ``0.0_0.0`` key included)
    before any shuffle."""
    parts = F.split(F.col(col), "_")
    zero = ["0.0", "-0.0"]
    return (F.col(col).isNotNull() & ~F.get(parts, 0).isin(zero)
            & ~F.get(parts, 1).isin(zero))


def airborne(col: str = "on_ground") -> Column:
    """``COALESCE(on_ground, false) = FALSE``."""
    return ~on_ground_or_false(col)


_OPS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    ">=": lambda c, v: c >= v,
    "=~": lambda c, v: c.rlike(v),
    "!~": lambda c, v: ~c.rlike(v),
}


def adhoc_filter(df: DataFrame, filters: Iterable[tuple[str, str, object]]) -> DataFrame:
    """F8: dashboard ad-hoc filters, a list of ``(column, operator, value)``
    ANDed together. Values become typed literals; no SQL text is built from
    user input. Unknown columns or operators raise ``ValueError``."""
    conds = []
    for name, op, value in filters:
        if name not in df.columns:
            raise ValueError(f"unknown column {name!r}")
        if op not in _OPS:
            raise ValueError(f"unknown operator {op!r}")
        # A regex stays a plain string pattern; other values become literals
        # of the column's own type.
        arg = str(value) if op in ("=~", "!~") else _typed_lit(df, name, value)
        conds.append(_OPS[op](F.col(name), arg))
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


ALL = "All"


def country_filter(df: DataFrame, country: str | None, col: str = "fk_pays") -> DataFrame:
    """keep one country unless the pick is 'All' (or none)."""
    if country is None or country == ALL:
        return df
    return df.filter(F.col(col) == F.lit(country))
