"""Parsing, typing and row filters (FIXTURES E01-E12)."""

import datetime as dt
import json
import math

from pyspark.sql import functions as F

from sensorflow.functions.casts import cast_timestamps, conform_casts
from sensorflow.functions.json import map_lookup, parse_array
from sensorflow.operators.explode import explode_array
from sensorflow.plans.dims import location_rows, location_sensor_dims
from sensorflow.plans.measurements import (end_signals, latest_measurements, measurement_rows,
                                           parse_measurements)
from sensorflow.schemas import LOCATION
from sensorflow.sources.envelope import decode_value


def m(utc="2024-01-01T00:00:00Z", local="2024-01-01T01:00:00+01:00", value=1.5, lat=48.85, lon=2.35,
      sensor=7, location=3):
    d = {"datetime": {"utc": utc, "local": local}, "value": value,
         "coordinates": {"latitude": lat, "longitude": lon}, "sensorsId": sensor, "locationsId": location}
    if local is None:
        del d["datetime"]["local"]
    return json.dumps(d, allow_nan=True)


def test_e01_malformed_measurement_gives_no_row(spark, envelope):
    parsed = parse_measurements(decode_value(envelope(["{bad"])))
    row = parsed.collect()[0]
    assert row.data is None or all(v is None for v in row.data)
    assert measurement_rows(parsed).count() == 0


def test_e02_malformed_array_loses_whole_message(spark, envelope):
    rows = location_rows(decode_value(envelope(['[{"id":1},{bad'])))
    assert rows.count() == 0


def test_e03_bad_field_nulls_only_that_field(spark, envelope):
    rows = location_rows(decode_value(envelope(['[{"id":"x","name":"a"},{"id":3,"name":"b"}]'])))
    got = {r.name: r.location_id for r in rows.collect()}
    assert got == {"a": None, "b": 3}


def test_e04_object_where_array_declared(spark, envelope):
    rows = location_rows(decode_value(envelope(['{"id":1,"name":"solo"}'])))
    assert [(r.location_id, r.name) for r in rows.collect()] == [(1, "solo")]


def test_e05_location_without_sensors(spark, envelope):
    msgs = envelope(['[{"id":1,"name":"a","sensors":[]},{"id":2,"name":"b"},'
                     '{"id":3,"name":"c","sensors":[{"id":9,"name":"s","parameter":{"id":2}}]}]'])
    loc, sen = location_sensor_dims(decode_value(msgs))
    assert sorted(r.location_id for r in loc.collect()) == [3]
    assert [(r.sensor_id, r.parameter_id, r.location_id) for r in sen.collect()] == [(9, 2, 3)]
    loc_all, _ = location_sensor_dims(decode_value(msgs), keep_empty=True)
    assert sorted(r.location_id for r in loc_all.collect()) == [1, 2, 3]


def test_e07_e08_coordinates(spark, envelope):
    msgs = envelope(['[{"id":1,"coordinates":null},{"id":2,"coordinates":{"longitude":2.35}},'
                     '{"id":3,"coordinates":{"latitude":48.85,"longitude":"bad"}}]'])
    got = {r.location_id: (r.latitude, r.longitude) for r in location_rows(decode_value(msgs)).collect()}
    assert got == {1: (None, None), 2: (None, 2.35), 3: (48.85, None)}


def test_e09_timestamps_instant_and_wall_clock(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "2024-01-01T01:00:00+01:00")], "u string, l string")
    u, loc = cast_timestamps("u", "l")
    _, loc_instant = cast_timestamps("u", "l", local_mode="instant")
    r = df.select(F.unix_micros(u).alias("u"), loc.alias("l"), F.unix_micros(loc_instant).alias("li")).first()
    assert r.u == 1704067200 * 10**6
    assert r.l == dt.datetime(2024, 1, 1, 1, 0)
    assert r.li == r.u


def test_e10_e11_incomplete_rows_dropped_without_error(spark, envelope):
    msgs = envelope([m(utc="nope"), m(value=float("nan")), m(value=None), m(local=None),
                     m(lat=None), m()])
    rows = measurement_rows(parse_measurements(decode_value(msgs))).collect()
    assert len(rows) == 1
    assert rows[0].latest_id == "7_3_2024-01-01 00:00:00"
    assert not math.isnan(rows[0].value)


def test_e12_end_marker_is_control_not_data(spark, envelope):
    parsed = parse_measurements(decode_value(envelope([m(), '{"end": true}'])))
    assert [r.data.end for r in end_signals(parsed).collect()] == ["true"]
    assert measurement_rows(parsed).count() == 1


def test_composite_key_ignores_session_time_zone(spark, envelope):
    parsed = parse_measurements(decode_value(envelope([m(utc="2024-01-01T00:00:00.120Z")])))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        key = latest_measurements(parsed).first().latest_id
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert key == "7_3_2024-01-01 00:00:00.12"


def test_map_lookup_missing_key_and_explode(spark):
    df = spark.createDataFrame([('[{"a": 1}, {"a": 2}]',), ("[]",), (None,)], "v string")
    arr = df.select(parse_array("v", "a int").alias("arr"))
    assert explode_array(arr, "arr", "e").count() == 2
    assert explode_array(arr, "arr", "e", keep_empty=True).count() == 4
    mp = spark.createDataFrame([({"x": "1"},)], "m map<string,string>")
    assert mp.select(map_lookup("m", "y").alias("y")).first().y is None


def test_conform_casts_ignores_missing_and_tolerates_garbage(spark):
    df = spark.createDataFrame([("12", "x")], "a string, b string")
    out = conform_casts(df, {"a": "int", "b": "int", "zzz": "int"}).first()
    assert (out.a, out.b) == (12, None)


def test_location_schema_is_the_documented_one():
    names = [f.name for f in LOCATION.fields]
    assert names == ["id", "name", "locality", "timezone", "country", "coordinates",
                     "datetimeFirst", "datetimeLast", "sensors"]


def test_time_bucket_ignores_session_time_zone(spark):
    from sensorflow.plans.marts import time_bucket
    df = spark.createDataFrame([("2024-01-01T10:47:00Z",)], "u string")
    col = time_bucket(F.col("u").try_cast("timestamp"), "hour")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = df.select(col.alias("b")).first().b
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 1, 1, 10, 0)
