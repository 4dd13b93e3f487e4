"""Golden rows for parsing and enrichment edge cases (FIXTURES.md §1-2)."""

import datetime as dt
import json

from pyspark.sql import Row

from flightlake.operators import enrich, parse, route, star


def _msgs(spark, texts):
    return spark.createDataFrame([Row(value=t) for t in texts])


GOOD = json.dumps({"icao24": "a00001", "callsign": "FL1 ", "origin_country": "FRANCE",
                   "time_position": 1704067200, "last_contact": 1704067201,
                   "longitude": 2.35, "latitude": 48.85, "on_ground": False,
                   "velocity": 200.0, "spi": False, "position_source": 0, "category": 3})


def test_state_mapping_good_row(spark):
    r = parse.flight_state_parse(_msgs(spark, [GOOD])).collect()[0]
    assert r.time_position == dt.datetime(2024, 1, 1, 0, 0, 0)
    assert r.position_source == "0"
    assert r.category is None
    assert r.callsign == "FL1 "
    f = star.fact_state(parse.flight_state_parse(_msgs(spark, [GOOD]))).collect()[0]
    assert f.fk_position == "48.85_2.35"


def test_malformed_and_arrays_go_nowhere_but_quarantine(spark):
    raw = _msgs(spark, ["not json", '["a00001",null,"FRANCE"]', GOOD])
    states = parse.flight_state_parse(raw)
    tables = star.star(states)
    assert tables["fait_etat_vol"].count() == 1
    assert tables["dim_pays"].count() == 1
    q = parse.flight_state_quarantine(raw).collect()
    assert sorted(r.raw for r in q) == sorted(["not json", '["a00001",null,"FRANCE"]'])


def test_wrong_types_give_nulls(spark):
    raw = _msgs(spark, ['{"icao24":"a00002","on_ground":1,"time_position":1704067200.0}'])
    s = parse.flight_state_parse(raw)
    r = s.collect()[0]
    assert r.on_ground is None and r.time_position is None
    t = star.star(s)
    assert t["dim_aeronef"].count() == 1
    assert t["fait_etat_vol"].count() == 0 and t["dim_temps"].count() == 0


def test_missing_callsign_and_latitude(spark):
    base = json.loads(GOOD)
    no_call = dict(base); no_call.pop("callsign")
    no_lat = dict(base); no_lat.pop("latitude"); no_lat["icao24"] = "a00009"
    s = parse.flight_state_parse(_msgs(spark, [json.dumps(no_call), json.dumps(no_lat)]))
    t = star.star(s)
    assert t["dim_vol"].count() == 1  # only the row that kept its callsign
    assert [r.fk_aeronef for r in t["fait_etat_vol"].collect()] == ["a00001"]
    assert t["dim_position"].count() == 1
    assert t["dim_aeronef"].count() == 2


def test_same_callsign_later_event_wins(spark):
    a = dict(json.loads(GOOD), squawk="1000", time_position=1704067200)
    b = dict(json.loads(GOOD), squawk="2000", time_position=1704067260)
    s = parse.flight_state_parse(_msgs(spark, [json.dumps(b), json.dumps(a)]))
    rows = star.dim_flight(s).collect()
    assert len(rows) == 1 and rows[0].squawk == "2000"


def _airport(spark, items, source="airports"):
    env = {"limit": 10, "totalCount": len(items), "totalPages": 1, "page": 0,
           "items": items, "source_data": source}
    return enrich.airport_enrich(parse.airport_parse(_msgs(spark, [json.dumps(env)])))


def _item(name="X", icao="LFMN", coords=None, geometry=True):
    it = {"name": name, "country": "FR", "icaoCode": icao, "iataCode": "NCE"}
    if geometry:
        it["geometry"] = {"type": "Point", "coordinates": coords}
    return it


def test_airport_enrichment_golden(spark):
    rows = _airport(spark, [
        _item(" Nice ", "LFMN", [7.2, 43.6]),
        {"geometry": {"type": "Point", "coordinates": [-118.4, 33.9]}},
        _item("K", "KX", [0.0, -10.0]),
        _item("E", "EX", [15.0, 9.99]),
        _item("Y", "YX", [150.0, 50.0]),
        _item("short", "AB", [3.0]),
        _item("nogeo", "AB", geometry=False),
    ]).collect()
    by = {r.name: r for r in rows}
    nice = by[" Nice "]
    assert (nice.altitude_estimee_m, nice.timezone_approx, nice.climat,
            nice.airport_category, nice.name_clean, nice.name_upper) == \
        (300, 0, "Tempéré", "Unknown", "Nice", " NICE ")
    na = by["N/A"]
    assert (na.icao, na.iata, na.country) == ("N/A", "N/A", "N/A")
    assert (na.altitude_estimee_m, na.timezone_approx, na.climat) == (300, -7, "Tempéré")
    assert (by["K"].altitude_estimee_m, by["K"].climat, by["K"].airport_category) == \
        (150, "Aride", "North America")
    assert (by["E"].altitude_estimee_m, by["E"].climat, by["E"].timezone_approx,
            by["E"].airport_category) == (50, "Tropical", 1, "Europe")
    assert (by["Y"].altitude_estimee_m, by["Y"].climat, by["Y"].timezone_approx,
            by["Y"].airport_category) == (500, "Polaire", 10, "Oceania")
    s = by["short"]
    assert (s.latitude, s.altitude_estimee_m, s.climat, s.timezone_approx, s.geo_score) == \
        (None, 500, "Polaire", 0, None)
    g = by["nogeo"]
    assert (g.latitude, g.longitude, g.timezone_approx, g.geo_score) == (None, None, None, None)
    assert all(r.processing_delay_s == 0 for r in rows)


def test_empty_items_and_unrouted(spark):
    assert _airport(spark, []).count() == 0
    env = [json.dumps({"items": None, "source_data": "airports"}),
           json.dumps({"items": [_item("a", "KA", [1.0, 2.0])], "source_data": "elsewhere"}),
           json.dumps({"items": [_item("b", "KB", [1.0, 2.0])]}),
           json.dumps({"items": [_item("c", "KC", [1.0, 2.0])], "source_data": "navaids"})]
    rows = enrich.airport_enrich(parse.airport_parse(_msgs(spark, env)))
    counts = {r.target: r.n_rows for r in route.route_counts(rows).collect()}
    assert counts == {"__unrouted__": 2, "navaids": 1}
