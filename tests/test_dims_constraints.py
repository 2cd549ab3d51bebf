"""Dimension jobs and constraints."""

import json

import pytest

from sensorflow.operators.constraints import (check_foreign_key, check_max_length, check_not_null,
                                              check_primary_key, parent_first_order, validate)
from sensorflow.plans.dims import country_parameter_dims
from sensorflow.schemas import COUNTRY_TABLE, MEASUREMENT_TABLE, TABLES
from sensorflow.sources.envelope import decode_value


def country(cid, params, code="FR"):
    return json.dumps({"id": cid, "code": code, "name": f"c{cid}", "datetimeFirst": "2024-01-01T00:00:00Z",
                       "datetimeLast": "2024-02-01T00:00:00Z",
                       "parameters": [{"id": p, "name": f"p{p}", "units": "u", "displayName": "api"}
                                      for p in params]})


def test_e15_e16_e17_parameters(spark, envelope):
    countries = envelope([country(1, [10, 11]), country(2, [])])
    topic = json.dumps([{"id": 10, "displayName": "Ten", "description": "d10"},
                        {"id": 99, "displayName": "Only in topic"}])
    params = envelope([(topic, 0), (topic, 1)])  # delivered twice
    c, p = country_parameter_dims(decode_value(countries), decode_value(params))
    assert [r.id for r in c.collect()] == [1]  # country 2 has no parameters
    got = {r.parameter_id: (r.name, r.display_name, r.description) for r in p.collect()}
    assert got == {10: ("p10", "Ten", "d10"), 11: ("p11", None, None)}


def test_e18_e19_validate_and_quarantine(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, 1.0), ("b", 2, 99, 2.0), ("c", None, None, 3.0), ("a", 1, 1, 4.0), (None, 1, 1, 5.0)],
        "latest_id string, location_id int, sensor_id int, value double")
    sensors = spark.createDataFrame([(1,), (2,)], "sensor_id int")
    locations = spark.createDataFrame([(1,), (2,)], "location_id int")
    valid, quarantine = validate(rows, MEASUREMENT_TABLE, {"sensor": sensors, "location_table": locations})
    assert sorted(r.latest_id for r in valid.collect()) == ["c"]  # NULL FKs pass
    rules = sorted(((json.loads(r.row_json)["latest_id"], r.rule) for r in quarantine.collect()), key=repr)
    assert rules == sorted([(None, "pk_null"), ("a", "pk_duplicate"), ("a", "pk_duplicate"),
                            ("b", "fk:sensor_id->sensor")], key=repr)
    codes = spark.createDataFrame([(1, "ABCDEFGHIJK", "n"), (2, "FR", None)], "id int, code string, name string")
    _, q = validate(codes, COUNTRY_TABLE)
    assert sorted((r.table, r.rule) for r in q.collect()) == [("country", "max_length:code"),
                                                               ("country", "not_null:name")]
    with pytest.raises(ValueError):
        validate(codes, COUNTRY_TABLE, mode="strict")


def test_valid_union_quarantine_is_input(spark):
    df = spark.range(100).selectExpr("cast(id % 40 as int) as id", "'XX' as code", "'n' as name")
    valid, q = validate(df, COUNTRY_TABLE)
    assert valid.count() + q.select("row_json").count() == 100


def test_single_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "toolong")], "k int, s string")
    assert sorted((r.k, r.n) for r in check_primary_key(df, ["k"]).collect()
                  if r.k is not None) == [(1, 2)]
    assert check_not_null(df, ["k"]).count() == 1
    assert check_max_length(df, {"s": 3}).count() == 1
    parent = df.sparkSession.createDataFrame([(2,)], "k int")
    assert check_foreign_key(df, "k", parent, "k").count() == 2


def test_f5_parent_first_order():
    order = parent_first_order(list(TABLES.values()))
    assert order.index("country") < order.index("location_table") < order.index("sensor")
    assert order.index("parameter") < order.index("sensor") < order.index("latest_measurements")


def test_c6_guard_and_parent_first_writes(spark):
    from sensorflow.plans.jobs import write_in_order
    from sensorflow.session import scratch_path
    from sensorflow.sources.keyed_table import KeyedTable
    root = scratch_path(spark, "test-jobs")
    tables = {n: KeyedTable(spark, f"{root}/{n}", list(TABLES[n].key), buckets=2)
              for n in ("country", "location_table", "sensor")}
    country = spark.createDataFrame([(1, "FR", "France", None, None)],
                                    "id int, code string, name string, datetimeFirst timestamp, datetimeLast timestamp")
    loc_cols = ("location_id int, name string, locality string, country_id int, latitude double, "
                "longitude double, timezone string, datetime_first_utc timestamp, datetime_first_local timestamp_ntz, "
                "datetime_last_utc timestamp, datetime_last_local timestamp_ntz")
    locations = spark.createDataFrame([(10, "a", None, 1, None, None, None, None, None, None, None),
                                       (11, "b", None, 2, None, None, None, None, None, None, None)], loc_cols)
    no_sensors = spark.createDataFrame([], "sensor_id int, name string, parameter_id int, location_id int")
    out = write_in_order(spark, {"country": country, "location_table": locations, "sensor": no_sensors}, tables)
    assert out["location_table"]["skipped"] and out["sensor"]["skipped"]
    assert out["country"]["inserts"] == 1
    sensors = spark.createDataFrame([(100, "s", None, 10), (101, "t", None, 11)],
                                    "sensor_id int, name string, parameter_id int, location_id int")
    out = write_in_order(spark, {"location_table": locations, "sensor": sensors}, tables)
    # location 11 points at an unknown country: quarantined, and so is its sensor
    assert out["location_table"] == {"inserts": 1, "updates": 0, "quarantined": 1, "skipped": False}
    assert out["sensor"] == {"inserts": 1, "updates": 0, "quarantined": 1, "skipped": False}
    assert [r.sensor_id for r in tables["sensor"].read().collect()] == [100]


def test_redrive_after_parent_arrives(spark):
    from sensorflow.operators.constraints import redrive
    from sensorflow.schemas import SENSOR_TABLE
    sensors = spark.createDataFrame([(1, "a", None, 10), (2, "b", None, 99)],
                                    "sensor_id int, name string, parameter_id int, location_id int")
    locations = spark.createDataFrame([(10,)], "location_id int")
    valid, quarantine = validate(sensors, SENSOR_TABLE, {"location_table": locations})
    assert [r.sensor_id for r in valid.collect()] == [1]
    back = redrive(quarantine, SENSOR_TABLE, rules=["fk:location_id->location_table"])
    assert [tuple(r) for r in back.collect()] == [(2, "b", None, 99)]
    late = locations.unionByName(spark.createDataFrame([(99,)], "location_id int"))
    valid2, q2 = validate(back, SENSOR_TABLE, {"location_table": late})
    assert [r.sensor_id for r in valid2.collect()] == [2] and q2.count() == 0


def test_e06_country_with_null_parameters(spark, envelope):
    msgs = envelope([json.dumps({"id": 5, "code": "XX", "name": "n", "parameters": None}),
                     country(6, [1])])
    empty_topic = envelope(["[]"])
    c, p = country_parameter_dims(decode_value(msgs), decode_value(empty_topic))
    assert [r.id for r in c.collect()] == [6]
    c_all, p_all = country_parameter_dims(decode_value(msgs), decode_value(empty_topic), keep_empty=True)
    assert sorted(r.id for r in c_all.collect()) == [5, 6]
    assert [r.parameter_id for r in p_all.collect()] == [1]  # no NULL parameter row
