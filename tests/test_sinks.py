"""Sinks, publishing, quarantine and marts: rules that no oracle row shows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sensorflow.operators.constraints import redrive, validate
from sensorflow.plans.marts import dimension_stats, dimension_stats_of, measurement_star
from sensorflow.schemas import ENVELOPE, MEASUREMENT_TABLE, PARAMETER_TABLE
from sensorflow.session import checkpoint_root, discard, materialize, scratch_path
from sensorflow.sources.jdbc import JdbcUpsertSink
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.sources.pages import page_coverage
from sensorflow.sources.publish import (bounded_chunks, publish_array, publish_if_empty, publish_then_end,
                                        publish_to_empty_topic)


def test_duplicate_keys_are_refused_and_nothing_is_written(spark):
    kt = KeyedTable(spark, scratch_path(spark, "dup"), "k", buckets=2)
    kt.upsert(spark.createDataFrame([(1, "a")], "k long, v string"))
    with pytest.raises(Exception, match="duplicate key"):
        kt.upsert(spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k long, v string"))
    assert [tuple(r) for r in kt.read().collect()] == [(1, "a")]


def test_only_touched_partitions_are_rewritten(spark):
    path = scratch_path(spark, "touched")
    kt = KeyedTable(spark, path, ["a", "b"], partition_by={"pa": F.col("a"), "pb": F.col("b")})
    rows = [(a, b, "old") for a in range(2) for b in range(2)]
    assert kt.upsert(spark.createDataFrame(rows, "a long, b long, v string")) == (4, 0)
    def untouched():
        return {f for f in spark.read.parquet(path).inputFiles() if "pa=0/pb=1" in f or "pa=1/pb=0" in f}

    files = untouched()
    # the product of the touched values covers all four partitions
    assert kt.upsert(spark.createDataFrame([(0, 0, "new"), (1, 1, "new")], "a long, b long, v string")) == (0, 2)
    assert len(files) == 2 and untouched() == files
    assert sorted(tuple(r) for r in kt.read().collect()) == [
        (0, 0, "new"), (0, 1, "old"), (1, 0, "old"), (1, 1, "new")]


def test_a_large_partition_is_written_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = scratch_path(spark, "hot")
        kt = KeyedTable(spark, path, "id", partition_by={"day": F.lit(1)})
        kt.upsert(spark.range(300_000).withColumn("v", F.sha2(F.col("id").cast("string"), 256)))
        assert len(spark.read.parquet(path).inputFiles()) > 1
        assert kt.read().count() == 300_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_a_table_of_a_spec_exists_typed_and_empty(spark):
    kt = KeyedTable(spark, scratch_path(spark, "spec"), list(PARAMETER_TABLE.key), buckets=1, spec=PARAMETER_TABLE)
    assert kt.exists() and kt.read().schema == PARAMETER_TABLE.struct_type()
    row = spark.createDataFrame([(1, "n", "u", "d", "x")], "parameter_id int, name string, unit string, "
                                                            "display_name string, description string")
    assert kt.upsert(row) == (1, 0)
    assert dict(kt.read().dtypes)["parameter_id"] == "bigint"


def test_an_unreadable_table_is_not_taken_for_an_empty_one(spark, tmp_path):
    bad = tmp_path / "t"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        KeyedTable(spark, str(bad), "k", buckets=1).exists()


class Database:
    """Records statements; counts as a database would report them."""

    def __init__(self, answers):
        self.answers, self.sql, self.staged = answers, [], []

    def execute(self, sql):
        self.sql.append(sql)
        return self.answers.get(sql.split()[0], [])

    def write(self, df, url, table, *_):
        self.staged.append((table, df.count()))


@pytest.mark.parametrize("dialect, answers, want", [
    ("postgres", {"WITH": [(2, 1)]}, (2, 1)), ("merge", {"SELECT": [(3, 1)]}, (2, 1))])
def test_database_sink_fits_jobs_and_streams(spark, dialect, answers, want):
    from test_stream_end import msg, parsed
    from sensorflow.streaming.runner import MeasurementUpsert
    db = Database(answers)
    sink = JdbcUpsertSink(spark, "jdbc:none", "latest_measurements", MEASUREMENT_TABLE.column_names, "latest_id",
                          db.execute, dialect=dialect, write=db.write)
    body = MeasurementUpsert(spark, sink)
    body(parsed(spark, [(0, i, msg(i, 0, 1.0)) for i in range(3)]), 0)
    assert (body.last_metrics["inserts"], body.last_metrics["updates"]) == want
    assert db.staged == [("stage_latest_measurements", 3)]
    kinds = [s.split()[0] for s in db.sql]
    assert kinds == (["WITH", "DROP"] if dialect == "postgres" else ["SELECT", "MERGE", "DROP"])


def test_redrive_keeps_microseconds_and_large_ids(spark):
    row = ("k", 3_000_000_000, 4_000_000_000, 1.5, dt.datetime(2024, 1, 1, 0, 0, 0, 123456),
           dt.datetime(2024, 1, 1, 1, 0, 0, 654321), 1.0, 2.0)
    df = spark.createDataFrame([row], "latest_id string, location_id long, sensor_id long, value double, "
                                      "timestamp_utc timestamp, timestamp_local timestamp_ntz, latitude double, "
                                      "longitude double")
    none = spark.createDataFrame([], "location_id long")
    checked = validate(df, MEASUREMENT_TABLE, {"location_table": none})
    assert [tuple(r) for r in redrive(checked[1], MEASUREMENT_TABLE).collect()] == [tuple(r) for r in df.collect()]


def test_marker_follows_the_data(spark):
    rows = spark.createDataFrame([(None, b"x", "t", p, o, dt.datetime(2024, 1, 1), 0)
                                  for p in (0, 1) for o in range(3)], ENVELOPE)
    writes = []
    publish_then_end(rows, lambda df: writes.append([(r["partition"], bytes(r["value"])) for r in df.collect()]))
    assert len(writes) == 2 and all(v == b"x" for _, v in writes[0])
    assert sorted(writes[1]) == [(0, b'{"end":true}'), (1, b'{"end":true}')]


def test_a_topic_that_cannot_be_read_is_not_published_to(spark, tmp_path):
    rows = spark.createDataFrame([(None, b"x", "t", 0, 0, dt.datetime(2024, 1, 1), 0)], ENVELOPE)
    written = []

    def broken():
        raise OSError("no broker")

    assert publish_to_empty_topic(rows, broken, written.append) is False and not written
    assert publish_to_empty_topic(rows, lambda: rows.limit(0), written.append) is True and len(written) == 1
    assert publish_to_empty_topic(rows, lambda: rows, written.append) is False and len(written) == 1
    path = str(tmp_path / "topic")
    assert publish_if_empty(spark, rows, path) and not publish_if_empty(spark, rows, path)


def test_repeated_rows_are_split_over_chunks(spark):
    df = spark.range(10_000).select(F.lit(1).alias("g"), F.lit("same").alias("v"))
    chunks = bounded_chunks(df, ["g"], 64)
    sizes = [r["count"] for r in chunks.groupBy("__chunk").count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 3 * 64
    assert chunks.drop("__chunk").columns == df.columns
    messages = publish_array(chunks, "t", ["g"], F.col("__chunk"), "g", payload=["g", "v"])
    assert messages.count() == len(sizes)


def test_a_missing_middle_page_is_incomplete(spark):
    body = '{"meta": {"found": 60, "limit": 25}, "results": []}'
    pages = spark.createDataFrame([(1, p, body) for p in (1, 3)] + [(2, p, body) for p in (1, 2, 3)],
                                  "entity_id long, page int, body string")
    got = {r["entity_id"]: r["complete"] for r in page_coverage(pages).collect()}
    assert got == {1: False, 2: True}


def stats_inputs(spark, values):
    fact = spark.createDataFrame([(i, 1 + i % 2, 10 + i % 3, v) for i, v in enumerate(values)],
                                 "i long, location_id long, sensor_id long, value double")
    location = spark.createDataFrame([(1, "l1", 5), (2, "l2", 6)], "location_id long, name string, country_id long")
    country = spark.createDataFrame([(5, "A"), (6, "B")], "id long, name string")
    sensor = spark.createDataFrame([(10, "s", 1), (11, "s", 1), (12, "s", 2)],
                                   "sensor_id long, name string, parameter_id long")
    parameter = spark.createDataFrame([(1, "p1", "u"), (2, "p2", "u")],
                                      "parameter_id long, name string, unit string")
    return fact, location, country, sensor, parameter


def test_stats_do_not_round_and_partial_aggregates_agree(spark):
    inputs = stats_inputs(spark, [0.004, 0.004, 0.003, 1e-9, 2.5, None, 7.125])
    by = ["country_name", "parameter_name"]
    whole = {(r[0], r[1]): r for r in dimension_stats(measurement_star(*inputs), by).collect()}
    parts = {(r[0], r[1]): r for r in dimension_stats_of(*inputs, by).collect()}
    assert whole.keys() == parts.keys()
    for k, a in whole.items():
        b = parts[k]
        assert (a["n"], a["min_value"], a["max_value"]) == (b["n"], b["min_value"], b["max_value"])
        for c in ("avg_value", "sum_value"):
            assert b[c] == (a[c] if a[c] is None else pytest.approx(a[c], rel=1e-12))
    total = sum(r["sum_value"] or 0 for r in whole.values())
    assert total == pytest.approx(0.011 + 1e-9 + 2.5 + 7.125, rel=1e-12)


def test_stats_of_values_that_are_no_numbers(spark):
    inputs = stats_inputs(spark, [math.inf, 1.0, 2.0, 3.0, 4.0, math.nan])
    rows = {(r[0], r[1]): r for r in dimension_stats_of(*inputs, ["country_name", "parameter_name"]).collect()}
    flat = [r["sum_value"] for r in rows.values()]
    assert any(x == math.inf for x in flat) and any(math.isnan(x) for x in flat)


def test_discard_removes_only_what_was_materialized(spark, tmp_path):
    import os
    kept = str(tmp_path / "kept")
    spark.range(3).write.parquet(kept)
    stage = materialize(spark.range(5))
    folder = stage.inputFiles()[0].split(":", 1)[1].rsplit("/", 1)[0]
    folder = "/" + folder.lstrip("/")
    assert os.path.isdir(folder)
    discard(stage, spark.read.parquet(kept))
    assert not os.path.exists(folder) and os.path.isdir(kept)


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    """The settings of a session, for a master that is not here."""

    def __init__(self, **values):
        self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session(spark__master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session(spark__master="local-cluster[2,1,1024]"))
    named = Session(spark__master="yarn", **{"spark__checkpoint__dir": "hdfs://shared/c/"})
    assert checkpoint_root(named) == "hdfs://shared/c"
