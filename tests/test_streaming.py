"""Measurement stream: file topic -> foreachBatch upsert, metrics, end signal, replay."""

import datetime as dt
import json

import pytest

from sensorflow.schemas import ENVELOPE
from sensorflow.session import scratch_path
from sensorflow.sources.envelope import file_topic_source, write_file_topic
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.streaming.runner import MeasurementUpsert, await_and_stop, start_measurement_stream


def msg(sensor, minute, value):
    return json.dumps({"datetime": {"utc": f"2024-01-01T00:{minute:02d}:00Z",
                                    "local": f"2024-01-01T01:{minute:02d}:00+01:00"},
                       "value": value, "coordinates": {"latitude": 1.0, "longitude": 2.0},
                       "sensorsId": sensor, "locationsId": 1})


def batch(spark, values, first_offset):
    rows = [(None, v.encode(), "m", 0, first_offset + i, dt.datetime(2024, 1, 1, 0, 0, i), 0)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def test_stream_batches_counts_end_and_replay(spark):
    root = scratch_path(spark, "test-stream")
    kt = KeyedTable(spark, f"{root}/table", "latest_id", buckets=2)
    sink = MeasurementUpsert(spark, kt, metrics_path=f"{root}/metrics")
    plan = [
        [msg(1, 0, 1.0), msg(1, 0, 1.0), msg(2, 0, 2.0)],        # duplicate inside the batch
        [msg(1, 0, 9.0), msg(3, 1, 3.0), '{"bad'],               # update + insert + junk
        [msg(4, 2, 4.0), '{"end": true}'],
    ]
    offset = 0
    for values in plan:
        write_file_topic(batch(spark, values, offset), f"{root}/topic")
        offset += len(values)
        q = start_measurement_stream(file_topic_source(spark, f"{root}/topic", streaming=True), sink,
                                     f"{root}/checkpoint", available_now=True)
        await_and_stop(q, timeout=300)
    metrics = sorted(tuple(r) for r in spark.read.parquet(f"{root}/metrics")
                     .select("batch_id", "rows", "inserts", "updates", "end_seen").collect())
    assert metrics == [(0, 3, 2, 0, False), (1, 2, 1, 1, False), (2, 1, 1, 0, True)]
    assert sink.end_seen and sink.end_batch_id == 2
    table = {r.latest_id: r.value for r in kt.read().collect()}
    assert table == {"1_1_2024-01-01 00:00:00": 9.0, "2_1_2024-01-01 00:00:00": 2.0,
                     "3_1_2024-01-01 00:01:00": 3.0, "4_1_2024-01-01 00:02:00": 4.0}
    # replaying batch 1 leaves the table unchanged and rewrites its metrics row
    replay = spark.read.schema(ENVELOPE).parquet(f"{root}/topic").filter("offset between 3 and 5")
    from sensorflow.plans.measurements import parse_measurements
    from sensorflow.sources.envelope import decode_value
    sink(parse_measurements(decode_value(replay)), 1)
    assert {r.latest_id: r.value for r in kt.read().collect()} == table
    assert spark.read.parquet(f"{root}/metrics").filter("batch_id = 1").count() == 1


def test_checkpoint_required(spark):
    with pytest.raises(ValueError):
        start_measurement_stream(None, None, "")


def test_stream_equals_batch_on_test_table(spark):
    """I3 as a 3-batch file stream (with redelivered messages) gives the same
    table as the batch composition over all messages."""
    from pyspark.sql import functions as F

    from sensorflow.plans import feeds
    from sensorflow.plans.measurements import latest_measurements, parse_measurements
    from sensorflow.schemas import WIDE_MESSAGES
    from sensorflow.sources.envelope import decode_value
    events = feeds.table(spark, "/root/testdata/sf0.001", "events")
    day = F.dayofmonth("ts")
    root = scratch_path(spark, "test-stream-batch")
    kt = KeyedTable(spark, f"{root}/table", "latest_id", buckets=2)
    sink = MeasurementUpsert(spark, kt)
    chunks = [events.filter(day <= 10), events.filter((day > 10) & (day <= 20)), events.filter(day > 20)]
    for i, chunk in enumerate(chunks):
        env = feeds.measurement_messages(chunk)
        if i:
            env = env.unionByName(feeds.measurement_messages(chunks[i - 1])
                                  .withColumn("offset", F.col("offset") + F.lit(10**12)))
        write_file_topic(env, f"{root}/topic")
        q = start_measurement_stream(file_topic_source(spark, f"{root}/topic", streaming=True), sink,
                                     f"{root}/checkpoint", available_now=True, schemas=WIDE_MESSAGES)
        await_and_stop(q, timeout=300)
    batch = latest_measurements(parse_measurements(decode_value(feeds.measurement_messages(events)),
                                                   WIDE_MESSAGES))
    cols = batch.columns
    got = sorted(tuple(r) for r in kt.read().select(*cols).collect())
    want = sorted(tuple(r) for r in batch.collect())
    assert len(got) == events.count() and got == want
