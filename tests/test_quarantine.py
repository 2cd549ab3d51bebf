"""Rows held for missing parents come back by themselves."""

import datetime as dt

import pytest

from sensorflow.plans.jobs import write_in_order
from sensorflow.plans.measurements import parse_measurements
from sensorflow.schemas import COUNTRY_TABLE, LOCATION_TABLE, MEASUREMENT_TABLE, PARAMETER_TABLE, SENSOR_TABLE, TABLES
from sensorflow.session import scratch_path
from sensorflow.sources.envelope import decode_value
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.sources.quarantine import QuarantineStore
from sensorflow.streaming.runner import MeasurementUpsert
from test_stream_end import envelope
from test_streaming import msg

DIMS = ("country", "parameter", "location_table", "sensor")


def frame(spark, spec, rows):
    full = [tuple(r) + (None,) * (len(spec.columns) - len(r)) for r in rows]
    return spark.createDataFrame(full, spec.struct_type())


@pytest.fixture
def job(spark):
    root = scratch_path(spark, "quarantine")
    tables = {n: KeyedTable(spark, f"{root}/{n}", list(TABLES[n].key), buckets=1, spec=TABLES[n]) for n in DIMS}
    store = QuarantineStore(spark, f"{root}/held")

    def run(**frames):
        specs = {"country": COUNTRY_TABLE, "parameter": PARAMETER_TABLE, "location_table": LOCATION_TABLE, "sensor": SENSOR_TABLE}
        return write_in_order(spark, {n: frame(spark, specs[n], r) for n, r in frames.items()}, tables, store=store)

    def state():
        return ({n: sorted(r[0] for r in tables[n].read().collect()) for n in DIMS if tables[n].read().count()},
                sorted((r["table"], r["copies"], tuple(r["rules"])) for r in store.read().collect()))

    return run, state


def test_orphans_of_two_levels_come_back_in_one_job(job):
    run, state = job
    run(parameter=[(1, "pm25")])
    out = run(location_table=[(10, "a", None, 7), (11, "b", None, 8)], sensor=[(100, "s", 1, 10), (101, "t", 1, 11), (102, "u", 2, 10)])
    assert out["location_table"]["quarantined"] == 2 and out["sensor"]["quarantined"] == 3
    stored, held = state()
    assert stored == {"parameter": [1]} and len(held) == 5
    out = run(country=[(7, "C", "name")])
    assert out["location_table"] == {"inserts": 1, "updates": 0, "quarantined": 0, "released": 1, "skipped": False}
    assert out["sensor"]["released"] == 1
    stored, held = state()
    assert stored == {"country": [7], "parameter": [1], "location_table": [10], "sensor": [100]}
    # the rest waits for country 8 and parameter 2
    assert [h[0] for h in held] == ["location_table", "sensor", "sensor"]
    run(parameter=[(2, "o3")])
    run(country=[(8, "D", "name")])
    stored, held = state()
    assert stored["sensor"] == [100, 101, 102] and held == []


def test_rows_with_other_faults_stay(job):
    run, state = job
    run(location_table=[(10, None, None, 7), (None, "x", None, 7), (12, "ok", None, 7)], sensor=[(1, "s", None, None)])
    out = run(country=[(7, "C", "name")])
    assert out["location_table"]["released"] == 1
    stored, held = state()
    assert stored["location_table"] == [12]
    assert held == [("location_table", 1, ("not_null:name", "fk:country_id->country")),
                    ("location_table", 1, ("pk_null", "fk:country_id->country"))]


def test_a_delivered_row_goes_before_a_held_one_and_equal_rows_are_counted(job):
    run, state = job
    run(location_table=[(10, "old", None, 7), (10, "other", None, 7)], sensor=[(1, "s", None, None)])
    run(location_table=[(11, "x", None, 7), (11, "x", None, 7)], sensor=[(2, "s", None, None)])
    assert [h[1] for h in state()[1]] == [1, 1, 2]
    out = run(country=[(7, "C", "n")], location_table=[(10, "new", None, 7)], sensor=[(3, "s", None, None)])
    assert out["location_table"]["inserts"] == 1
    # duplicate keys were refused as such, and wait for a decision
    assert {h[2][0] for h in state()[1]} == {"pk_duplicate"}


def test_the_stream_takes_rows_back_when_parents_change_between_batches(spark):
    root = scratch_path(spark, "stream-held")
    locations = KeyedTable(spark, f"{root}/l", "location_id", buckets=1)
    sensors = KeyedTable(spark, f"{root}/s", "sensor_id", buckets=1)
    locations.upsert(spark.createDataFrame([(1, "x")], "location_id long, name string"))
    sensors.upsert(spark.createDataFrame([(1, "x")], "sensor_id long, name string"))
    kt = KeyedTable(spark, f"{root}/t", "latest_id", buckets=2, spec=MEASUREMENT_TABLE,
                    order=["_msg_ts", "_partition", "_offset"], changes_path=f"{root}/c")
    store = QuarantineStore(spark, f"{root}/q")
    sink = MeasurementUpsert(spark, kt, metrics_path=f"{root}/m", parents={"location_table": locations, "sensor": sensors}, store=store)

    def batch(n, rows):
        sink(parse_measurements(decode_value(envelope(spark, rows))), n)
        m = sink.last_metrics
        return m["rows"], m["inserts"], m["updates"], m["stale"], m["quarantined"], m["released"]

    assert batch(0, [(0, 0, msg(1, 0, 1.0)), (0, 1, msg(2, 0, 2.0)), (0, 2, msg(3, 0, 3.0))]) == (3, 1, 0, 0, 2, 0)
    sensors.upsert(spark.createDataFrame([(2, "y")], "sensor_id long, name string"))
    assert batch(1, [(0, 3, msg(1, 1, 1.5))]) == (1, 2, 0, 0, 0, 1)
    assert store.read().count() == 1
    # a newer message of a held key came in meanwhile: the held one must not replace it
    assert batch(2, [(0, 5, msg(3, 0, 9.0))]) == (1, 0, 0, 0, 1, 0)
    sensors.upsert(spark.createDataFrame([(3, "z")], "sensor_id long, name string"))
    assert batch(3, [(0, 4, msg(2, 0, 2.5)), (0, 6, '{"end": true}')]) == (1, 1, 1, 0, 0, 2)
    assert {r["latest_id"]: r["value"] for r in kt.read().collect()} == {
        "1_1_2024-01-01 00:00:00": 1.0, "1_1_2024-01-01 00:01:00": 1.5, "2_1_2024-01-01 00:00:00": 2.5, "3_1_2024-01-01 00:00:00": 9.0}
    assert store.read().count() == 0
    # a message older than the stored one, delivered late
    assert batch(4, [(0, 0, msg(2, 0, 7.0))]) == (1, 0, 0, 1, 0, 0)
    assert kt.read().filter("value = 7").isEmpty() and kt.changes(4).isEmpty()
    assert kt.read().columns == MEASUREMENT_TABLE.column_names
    assert dt.datetime(2024, 1, 1) == kt.read().agg({"timestamp_utc": "min"}).first()[0]
