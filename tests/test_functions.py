"""Small helpers: time window, keys, ad-hoc filters, country pick, documents."""

import datetime as dt
import json

import pytest
from flightlake.functions import columns as C
from flightlake.operators import extrapolate, filters


def test_last_minutes_window(spark):
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 11, 44, 59),),
                                (dt.datetime(2024, 1, 1, 11, 45, 0),),
                                (dt.datetime(2024, 1, 1, 12, 0, 0),),
                                (dt.datetime(2024, 1, 1, 12, 0, 1),)], "fk_temps timestamp_ntz")
    got = [r.fk_temps for r in filters.last_minutes(df, 15, now=now).collect()]
    assert got == [dt.datetime(2024, 1, 1, 11, 45), dt.datetime(2024, 1, 1, 12, 0)]


def test_keys_and_bands(spark):
    df = spark.createDataFrame([("FL1", dt.datetime(2024, 1, 1), 48.85, 2.35, 2.5, -499.4),
                                (None, dt.datetime(2024, 1, 1), None, 2.35, 3.5, -500.6)],
                               "callsign string, time_position timestamp_ntz, latitude double, "
                               "longitude double, a double, b double")
    rows = df.select(C.state_key().alias("k"), C.position_key().alias("p"),
                     C.round_half_even_int("a").alias("r"),
                     C.fixed_band(C.round_half_even_int("b")).alias("band")).collect()
    assert rows[0].k == "FL1_2024-01-01 00:00:00_48.85_2.35" and rows[0].p == "48.85_2.35"
    assert rows[1].k is None and rows[1].p is None
    assert (rows[0].r, rows[1].r) == (2, 4)  # half to even
    assert (rows[0].band, rows[1].band) == (0, -500)


def test_adhoc_filter_rejects_unknown(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    with pytest.raises(ValueError):
        filters.adhoc_filter(df, [("z", "=", 1)])
    with pytest.raises(ValueError):
        filters.adhoc_filter(df, [("x", "LIKE", 1)])
    assert filters.adhoc_filter(df, [("x", ">=", "1"), ("y", "!~", "^b")]).count() == 1
    assert filters.adhoc_filter(df, []).count() == 1


def test_country_filter_all(spark):
    df = spark.createDataFrame([("A",), ("B",)], "fk_pays string")
    assert filters.country_filter(df, "All").count() == 2
    assert filters.country_filter(df, None).count() == 2
    assert [r.fk_pays for r in filters.country_filter(df, "B").collect()] == ["B"]


def test_to_documents(spark):
    df = spark.sql("SELECT 5L AS time, 0 AS pos, "
                   "array(cast('a' as variant), cast(1.5d as variant), cast(null as variant)) AS state")
    r = extrapolate.to_documents(df).first()
    assert json.loads(r.value) == {"time": 5, "states": [["a", 1.5, None]]} and r.time == 5 and r.page_no == 0


def test_non_zero(spark):
    df = spark.createDataFrame([(None,), (0.0,), (2.0,)], "v double")
    assert [r.b for r in df.select(C.non_zero("v").alias("b")).collect()] == [False, False, True]
