"""Marts kept by changes: equal to a recomputation after any batches."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sensorflow.plans.marts import dimension_stats
from sensorflow.session import scratch_path
from sensorflow.sources.keyed_table import KeyedTable
from sensorflow.streaming.views import AggregateView, LatestView, hourly

ROWS = "latest_id string, location_id long, sensor_id long, timestamp_utc timestamp, value double"
INF, NAN = float("inf"), float("nan")


def fact(spark, root):
    day = F.to_date(F.col("timestamp_utc"))
    return KeyedTable(spark, f"{root}/fact", "latest_id", changes_path=f"{root}/changes",
                      partition_by={"day": day, "_b": F.pmod(F.xxhash64("latest_id"), F.lit(2))})


def row(sensor, minute, value):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return (f"{sensor}_{minute}", sensor % 3, sensor, at, value)


def canon(df, keys):
    names = [*keys, "n", "min_value", "avg_value", "max_value", "sum_value"]
    return sorted((tuple(round(v, 9) if isinstance(v, float) and math.isfinite(v) else str(v) if isinstance(v, float) else v
                         for v in r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("odd", [False, True])
def test_equal_to_a_recomputation_after_every_batch(spark, odd):
    root, rng = scratch_path(spark, "views"), random.Random(9 + odd)
    table, view, latest = fact(spark, root), hourly(spark, f"{root}/hourly", 2), LatestView(
        spark, f"{root}/latest", "sensor_id", ["timestamp_utc", "latest_id"], 1)
    values = [1.5, -2.0, 7.25, 0.0] + ([None, NAN, INF, -INF] if odd else [3.0])
    lost = 0
    for batch in range(4):
        keys = {(rng.randrange(4), rng.choice([1, 30, 61, 100, 1500])) for _ in range(9)}
        rows = spark.createDataFrame([row(s, m, rng.choice(values)) for s, m in sorted(keys)], ROWS)
        table.upsert(rows, batch_id=batch)
        changes = table.changes(batch)
        for v in (view, latest):
            v.apply(changes, table, batch)
        lost += view.recomputed
        now = table.read().withColumn("bucket", F.date_trunc("hour", F.col("timestamp_utc")).cast("timestamp_ntz"))
        group = ["location_id", "sensor_id", "bucket"]
        assert canon(view.read(), group) == canon(dimension_stats(now, group), group)
        assert canon(view.rolled_up(["location_id"]), ["location_id"]) == canon(dimension_stats(now, ["location_id"]), ["location_id"])
        newest = {}
        for r in now.collect():
            if r["sensor_id"] not in newest or (r["timestamp_utc"], r["latest_id"]) > newest[r["sensor_id"]][:2]:
                newest[r["sensor_id"]] = (r["timestamp_utc"], r["latest_id"], str(r["value"]))
        got = {r["sensor_id"]: (r["timestamp_utc"], r["latest_id"], str(r["value"])) for r in latest.read().collect()}
        assert got == newest
    assert lost > 0


def test_only_groups_that_lost_their_extreme_are_read_again(spark):
    root = scratch_path(spark, "extreme")
    table, view = fact(spark, root), hourly(spark, f"{root}/v", 1)

    def batch(n, rows):
        table.upsert(spark.createDataFrame(rows, ROWS), batch_id=n)
        view.apply(table.changes(n), table, n)
        return view.recomputed

    assert batch(0, [row(1, 0, 5.0), row(1, 1, 1.0), row(1, 2, 9.0), row(2, 0, 4.0), row(2, 1, 4.0)]) == 0
    assert batch(1, [row(1, 0, 6.0), row(2, 2, 8.0)]) == 0            # neither least nor greatest was replaced
    assert batch(2, [row(1, 1, 0.5)]) == 0                            # the least, by a lesser one
    assert batch(3, [row(1, 2, 2.0), row(2, 0, 4.0)]) == 1            # the greatest is gone; an equal row is no change
    assert canon(view.read(), ["sensor_id"]) == [(1, 3, 0.5, 8.5 / 3, 6.0, 8.5)] + [(2, 3, 4.0, 16 / 3, 8.0, 16.0)] or \
        canon(view.read(), ["sensor_id"]) == [(1, 3, 0.5, round(8.5 / 3, 9), 6.0, 8.5), (2, 3, 4.0, round(16 / 3, 9), 8.0, 16.0)]


def test_a_replayed_batch_is_not_added_again(spark):
    root = scratch_path(spark, "replay")
    table, view = fact(spark, root), hourly(spark, f"{root}/v", 1)
    for n, rows in enumerate([[row(1, 0, 5.0), row(1, 1, 1.0)], [row(1, 0, 7.0), row(1, 2, 2.0)]]):
        table.upsert(spark.createDataFrame(rows, ROWS), batch_id=n)
        view.apply(table.changes(n), table, n)
    before = canon(view.read(), ["sensor_id"])
    again = hourly(spark, f"{root}/v", 1)                              # after a restart
    table.upsert(spark.createDataFrame([row(1, 0, 7.0), row(1, 2, 2.0)], ROWS), batch_id=1)
    again.apply(table.changes(1), table, 1)
    assert canon(again.read(), ["sensor_id"]) == before == [(1, 3, 1.0, round(10 / 3, 9), 7.0, 10.0)]


def test_an_empty_batch_and_a_view_of_a_text_group(spark):
    root = scratch_path(spark, "empty")
    table = fact(spark, root)
    view = AggregateView(spark, f"{root}/v", {"kind": F.substring("latest_id", 1, 1)}, buckets=1)
    table.upsert(spark.createDataFrame([], ROWS), batch_id=0)
    view.apply(table.changes(0), table, 0)
    table.upsert(spark.createDataFrame([row(1, 0, 5.0), row(1, 1, None)], ROWS), batch_id=1)
    view.apply(table.changes(1), table, 1)
    assert canon(view.read(), ["kind"]) == [("1", 2, 5.0, 5.0, 5.0, 5.0)]
