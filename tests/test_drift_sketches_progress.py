"""Schema drift, sketches against exact values, progress and lag."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.aggregates import offset_bounds
from sensorflow.plans.distributions import RANK_ERROR, described, merged, sketched
from sensorflow.plans.drift import declared_paths, observed_fields, schema_drift, typed_paths
from sensorflow.plans.measurements import parse_measurements
from sensorflow.schemas import WIDE_MESSAGES
from sensorflow.session import scratch_path
from sensorflow.sources.envelope import decode_value, file_topic_source, write_file_topic
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.streaming.progress import ProgressStore, lag
from sensorflow.streaming.runner import MeasurementUpsert, await_and_stop, start_measurement_stream
from sensorflow.streaming.views import SketchView
from test_stream_end import envelope
from test_streaming import msg


def test_types_are_taken_apart():
    assert typed_paths("BIGINT") == [("", "BIGINT")]
    assert typed_paths("OBJECT<>") == [("", "OBJECT")]
    assert typed_paths("OBJECT<a: BIGINT, b: OBJECT<c: DECIMAL, d: ARRAY<OBJECT<e: STRING>>>, f: VOID>") == [
        ("", "OBJECT"), ("a", "BIGINT"), ("b", "OBJECT"), ("b.c", "DECIMAL"), ("b.d", "ARRAY"), ("b.d[]", "OBJECT"),
        ("b.d[].e", "STRING"), ("f", "VOID")]
    assert typed_paths("ARRAY<ARRAY<BIGINT>>") == [("", "ARRAY"), ("[]", "ARRAY"), ("[][]", "BIGINT")]


def test_odd_field_names_are_read_back(spark):
    names = ["plain", "with space", "a:b", "a, b", "<x>", "tick`ed", "é", "1st", "a.b"]
    rows = spark.createDataFrame([("{" + ", ".join(f'"{n}": 1' for n in names) + "}",)], "value string")
    got = {r["path"] for r in observed_fields(rows.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert got == {"", *names}


def test_drift_of_a_nested_schema(spark):
    declared = T.StructType.fromDDL("id bigint, at timestamp, m map<string,string>, tags array<struct<k:string>>, x struct<y:double>, note string")
    rows = ['{"id": 1, "at": "2024-01-01", "m": {"any": 1}, "tags": [{"k": "a"}], "x": {"y": 1}, "note": {"free": true}}',
            '{"id": "one", "at": 5, "m": "text", "tags": [{"k": 1, "new": 2}, {"k": null}], "x": {"y": 2.5e3}, "note": null}',
            '{"id": null, "tags": {"k": "lone"}, "x": [1]}', "cut {", None]
    df = spark.createDataFrame([("t", r) for r in rows] + [("u", '{"id": 1}')], "topic string, value string")
    got = {(r["topic"], r["path"], r["change"]): (r["types"], r["messages"]) for r in schema_drift(df, declared, ["topic"]).collect()}
    mine = {k[1:]: v for k, v in got.items() if k[0] == "t"}
    assert mine == {("", "retyped"): ("MALFORMED", 1), ("id", "retyped"): ("STRING", 1), ("at", "retyped"): ("BIGINT", 1),
                    ("m", "retyped"): ("STRING", 1), ("tags[].new", "added"): ("BIGINT", 1), ("x", "retyped"): ("ARRAY", 1),
                    ("x[]", "added"): ("BIGINT", 1), ("note.free", "added"): ("BOOLEAN", 1), ("tags.k", "added"): ("STRING", 1)}
    assert {k[1] for k in got if k[0] == "u" and k[2] == "missing"} == {p for p, _ in declared_paths(declared)} - {"", "id"}
    assert schema_drift(df.limit(0), declared, ["topic"]).count() == 0


def test_merged_sketches_equal_the_whole_within_the_bound(spark):
    rng = random.Random(1)
    data = [(k % 9, rng.choice([rng.gauss(0, 1), rng.randrange(5) * 1.0]), rng.randrange(900)) for k in range(30_000)]
    df = spark.createDataFrame([*data, (0, None, 5), (1, float("nan"), 901), (10, None, 1)], "day int, value double, sensor_id long").repartition(6)
    ranks = {f"r{k}": k / 20 for k in range(21)}
    days = sketched(df, ["day"])
    for got in (described(merged(days.withColumn("all", F.lit(1)), ["all"]), ranks).first(),
                described(sketched(df.withColumn("all", F.lit(1)), ["all"]), ranks).first()):
        values = sorted(v for _, v, _ in data)
        assert got["n"] == len(values) and got["sensors"] == len({s for *_, s in data} | {901})
        assert (got["r0"], got["r20"]) == (values[0], values[-1])
        for name, rank in ranks.items():
            low, high = bisect.bisect_left(values, got[name]), bisect.bisect_right(values, got[name])
            assert low <= (rank + RANK_ERROR) * len(values) + 1 and high >= (rank - RANK_ERROR) * len(values) - 1
    empty = described(days.filter("day = 10"), {"q": 0.5}).first()
    assert (empty["n"], empty["q"], empty["sensors"]) == (0, None, 1)


def test_sketch_view_merges_new_days_and_sketches_corrected_ones_anew(spark):
    root = scratch_path(spark, "sketch-view")
    day = F.to_date("timestamp_utc")
    table = KeyedTable(spark, f"{root}/t", "latest_id", partition_by={"day": day}, changes_path=f"{root}/c")
    view = SketchView(spark, f"{root}/v", ["kind"], lambda df: df.withColumn("kind", F.col("sensor_id") % 2))
    state = {}

    def batch(n, rows):
        frame = [(f"{s}_{d}_{m}", s, v, dt.datetime(2024, 1, d, 0, m)) for s, d, m, v in rows]
        state.update({r[0]: r for r in frame})
        table.upsert(spark.createDataFrame(frame, "latest_id string, sensor_id long, value double, timestamp_utc timestamp"), batch_id=n)
        view.apply(table.changes(n), table, n)
        got = {r["kind"]: (r["n"], r["sensors"], r["lo"], r["hi"]) for r in described(view.read(["kind"]), {"lo": 0, "hi": 1}).collect()}
        want = {}
        for kind in {r[1] % 2 for r in state.values()}:
            mine = [r for r in state.values() if r[1] % 2 == kind]
            want[kind] = (len(mine), len({r[1] for r in mine}), min(r[2] for r in mine), max(r[2] for r in mine))
        assert got == want

    batch(0, [(1, 1, 0, 5.0), (2, 1, 0, 6.0), (3, 2, 0, 7.0)])
    batch(1, [(1, 1, 1, 1.0), (5, 2, 0, 9.0), (4, 3, 0, 2.0)])
    batch(2, [(5, 2, 0, 0.5), (1, 3, 0, 4.0)])       # a correction takes back the greatest
    batch(2, [(5, 2, 0, 0.5), (1, 3, 0, 4.0)])       # the batch again
    batch(3, [(2, 1, 0, 6.0)])                       # nothing new


def test_a_held_back_batch_shows_as_lag(spark):
    root = scratch_path(spark, "lag")
    sink = MeasurementUpsert(spark, KeyedTable(spark, f"{root}/t", "latest_id", buckets=1), metrics_path=f"{root}/m", partitions=3)
    topic = envelope(spark, [(0, i, msg(i, 0, 1.0)) for i in range(10, 14)] + [(1, i, msg(i, 1, 1.0)) for i in range(5)])
    sink(parse_measurements(decode_value(topic.filter("partition = 0 AND offset < 12"))), 0)
    bounds = offset_bounds(topic)

    def behind():
        rows = lag(spark.read.parquet(f"{root}/m").withColumn("batch_id", F.col("batch_id").cast("bigint")), bounds).collect()
        return {(r["batch_id"], r["partition"]): (r["read_to"], r["behind"]) for r in rows}

    assert behind() == {(0, 0): (12, 2), (0, 1): (0, 5)}
    sink(parse_measurements(decode_value(topic.filter("partition = 1"))), 1)
    sink(parse_measurements(decode_value(topic.filter("partition = 0 AND offset >= 12"))), 2)
    assert behind() == {(0, 0): (12, 2), (0, 1): (0, 5), (1, 0): (12, 2), (1, 1): (5, 0), (2, 0): (14, 0), (2, 1): (5, 0)}


def test_progress_of_every_batch_is_stored(spark):
    root = scratch_path(spark, "progress")
    store = ProgressStore(spark, f"{root}/progress")
    spark.streams.addListener(store)
    try:
        sink = MeasurementUpsert(spark, KeyedTable(spark, f"{root}/t", "latest_id", buckets=1))
        total = 0
        for n in (3, 2):
            write_file_topic(envelope(spark, [(0, total + i, msg(total + i, 0, 1.0)) for i in range(n)]), f"{root}/topic")
            total += n
            query = start_measurement_stream(file_topic_source(spark, f"{root}/topic", streaming=True), sink, f"{root}/c",
                                             available_now=True, query_name="held", schemas=WIDE_MESSAGES)
            await_and_stop(query, timeout=300)
    finally:
        assert store.settled()
        spark.streams.removeListener(store)
    assert store.flush() >= 2 and store.flush() == 0
    rows = [r for r in store.read().orderBy("batch_id").collect() if r["input_rows"]]
    assert [(r["query"], r["batch_id"], r["input_rows"]) for r in rows] == [("held", 0, 3), ("held", 1, 2)]
    assert all(r["trigger_ms"] > 0 and r["started"] for r in rows) and store.failed is None


def test_a_level_of_no_sketch_is_refused():
    with pytest.raises(Exception):
        described(None, {"x": 2})
