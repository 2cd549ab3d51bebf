"""The stream is complete or fails: end records of all partitions, timeouts,
parents that change while it runs, rejected messages, restarts."""

import datetime as dt

import pytest

from sensorflow.plans.measurements import parse_measurements
from sensorflow.schemas import ENVELOPE
from sensorflow.session import scratch_path
from sensorflow.sources.envelope import decode_value, file_topic_source, write_file_topic
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.streaming.runner import MeasurementUpsert, await_and_stop, start_measurement_stream
from test_streaming import msg

END = '{"end": true}'


def envelope(spark, rows):
    """rows: (partition, offset, value)"""
    return spark.createDataFrame(
        [(None, v.encode(), "m", p, o, dt.datetime(2024, 1, 1, 0, 0, o), 0) for p, o, v in rows], ENVELOPE)


def parsed(spark, rows):
    return parse_measurements(decode_value(envelope(spark, rows)), keep_raw=True)


def test_marker_of_one_partition_does_not_end_the_stream(spark):
    root = scratch_path(spark, "end")
    kt = KeyedTable(spark, f"{root}/t", "latest_id", buckets=2)
    sink = MeasurementUpsert(spark, kt, metrics_path=f"{root}/m", partitions=2)
    sink(parsed(spark, [(0, 0, msg(1, 0, 1.0)), (0, 1, END), (1, 0, msg(2, 0, 2.0))]), 0)
    assert not sink.end_seen and sink.ended == {0}
    # a restart knows which partitions have ended
    sink = MeasurementUpsert(spark, kt, metrics_path=f"{root}/m", partitions=2)
    assert sink.ended == {0}
    sink(parsed(spark, [(1, 1, msg(3, 0, 3.0)), (1, 2, END)]), 1)
    assert sink.end_seen and sink.end_batch_id == 1
    assert kt.read().count() == 3


def test_running_query_stops_after_the_last_marker(spark):
    root = scratch_path(spark, "stop")
    kt = KeyedTable(spark, f"{root}/t", "latest_id", buckets=2)
    sink = MeasurementUpsert(spark, kt, partitions=2)
    write_file_topic(envelope(spark, [(0, 0, msg(1, 0, 1.0)), (0, 1, END)]).coalesce(1), f"{root}/topic")
    write_file_topic(envelope(spark, [(1, 0, msg(2, 0, 2.0)), (1, 1, END)]).coalesce(1), f"{root}/topic")
    query = start_measurement_stream(
        file_topic_source(spark, f"{root}/topic", streaming=True, max_files_per_trigger=1), sink, f"{root}/c")
    await_and_stop(query, sink, timeout=300)
    assert not query.isActive and sink.end_seen
    assert kt.read().count() == 2


def test_timeout_raises(spark):
    root = scratch_path(spark, "late")
    write_file_topic(envelope(spark, [(0, 0, msg(1, 0, 1.0))]), f"{root}/topic")
    sink = MeasurementUpsert(spark, KeyedTable(spark, f"{root}/t", "latest_id", buckets=2))
    query = start_measurement_stream(file_topic_source(spark, f"{root}/topic", streaming=True), sink, f"{root}/c")
    with pytest.raises(TimeoutError):
        await_and_stop(query, sink, timeout=0.2, poll=0.1)
    assert not query.isActive


def test_parents_are_read_for_each_batch(spark):
    root = scratch_path(spark, "parents")
    locations = KeyedTable(spark, f"{root}/locations", "location_id", buckets=1)
    locations.upsert(spark.createDataFrame([(1, "a")], "location_id long, name string"))
    kt = KeyedTable(spark, f"{root}/t", "latest_id", buckets=2)
    sink = MeasurementUpsert(spark, kt, quarantine_path=f"{root}/q", parents={"location_table": locations})
    other = msg(7, 0, 7.0).replace('"locationsId": 1', '"locationsId": 2')
    sink(parsed(spark, [(0, 0, msg(1, 0, 1.0)), (0, 1, other)]), 0)
    assert (sink.last_metrics["inserts"], sink.last_metrics["quarantined"]) == (1, 1)
    locations.upsert(spark.createDataFrame([(1, "b"), (2, "c")], "location_id long, name string"))
    sink(parsed(spark, [(0, 2, other)]), 1)
    assert (sink.last_metrics["inserts"], sink.last_metrics["quarantined"]) == (1, 0)


def test_a_row_with_two_broken_rules_counts_once(spark):
    root = scratch_path(spark, "rules")
    empty = spark.createDataFrame([], "location_id long, sensor_id long")
    sink = MeasurementUpsert(spark, KeyedTable(spark, f"{root}/t", "latest_id", buckets=2),
                             quarantine_path=f"{root}/q", parents={"location_table": empty, "sensor": empty})
    sink(parsed(spark, [(0, 0, msg(1, 0, 1.0))]), 0)
    assert sink.last_metrics["quarantined"] == 1
    assert spark.read.parquet(f"{root}/q").count() == 2


def test_rejected_messages_keep_their_text(spark):
    root = scratch_path(spark, "rejects")
    sink = MeasurementUpsert(spark, KeyedTable(spark, f"{root}/t", "latest_id", buckets=2),
                             rejects_path=f"{root}/r")
    bad, part = '{"bad', msg(1, 0, 1.0).replace('"value": 1.0', '"value": null')
    for _ in range(2):  # a replay replaces
        sink(parsed(spark, [(0, 0, bad), (0, 1, part), (0, 2, msg(2, 0, 2.0))]), 0)
    got = {(r["raw"], r["reason"]) for r in spark.read.parquet(f"{root}/r").collect()}
    assert got == {(bad, "unparsable"), (part, "incomplete:value")}
    assert spark.read.parquet(f"{root}/r").count() == 2
    assert (sink.last_metrics["rows"], sink.last_metrics["rejected"]) == (1, 2)


def test_jobs_from_topics_to_tables(spark):
    """Dimension job and measurement job on topics that ingestion published."""
    from sensorflow.plans import feeds
    from sensorflow.plans.jobs import dimension_job_from_topics
    from sensorflow.schemas import TABLES, WIDE_MESSAGES
    from sensorflow.streaming.runner import measurement_job
    sf, root = "/root/testdata/sf0.001", scratch_path(spark, "jobs")
    t = lambda name: feeds.table(spark, sf, name)
    topics = {"country": feeds.country_messages(t("orders"), t("lineitem")),
              "parameter": feeds.parameter_messages(t("part")),
              "locations": feeds.location_messages(t("customer"), t("orders"))}
    for name, rows in topics.items():
        write_file_topic(rows, f"{root}/{name}")
    tables = {n: KeyedTable(spark, f"{root}/t-{n}", list(TABLES[n].key), buckets=1, spec=TABLES[n])
              for n in ("country", "parameter", "location_table", "sensor")}
    done = dimension_job_from_topics(spark, tables, read=lambda n: file_topic_source(spark, f"{root}/{n}"),
                                     schemas=WIDE_MESSAGES)
    assert done["country"]["inserts"] == tables["country"].read().count() > 0
    assert done["parameter"]["inserts"] == tables["parameter"].read().count() > 0

    write_file_topic(envelope(spark, [(0, 0, msg(1, 0, 1.0)), (0, 1, END)]), f"{root}/measurements")
    sink = MeasurementUpsert(spark, KeyedTable(spark, f"{root}/m", "latest_id", buckets=1))
    measurement_job(spark, sink, f"{root}/c",
                    source=lambda: file_topic_source(spark, f"{root}/measurements", streaming=True), timeout=300)
    assert sink.end_seen and sink.table.read().count() == 1
