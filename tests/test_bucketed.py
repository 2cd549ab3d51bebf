"""Co-located tables: same rows as the plain operators, and no exchange of the stored side."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.operators.upsert import upsert
from sensorflow.session import scratch_path
from sensorflow.sources.bucketed import BucketedTable

ROWS = "sensor_id long, latest_id string, value double, at long"


@pytest.fixture
def stored(spark):
    """As on a cluster: no plan adapts or broadcasts because the test is small."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, 40, None]), f"m{rng.randrange(60)}", float(i), rng.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(rows, ROWS)
    table = BucketedTable(spark, f"t_{uuid.uuid4().hex}", scratch_path(spark, "bucketed"), ["sensor_id"], 5)
    table.write(df)
    yield table, df
    table.drop()
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def same(a, b):
    assert sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


def test_rows_and_files(spark, stored):
    table, df = stored
    same(table.read(), df)
    assert 1 <= len(spark.read.parquet(table.path).inputFiles()) <= 5


def test_dedupe_moves_nothing(stored):
    table, df = stored
    got = table.newest(["sensor_id", "latest_id"], ["at", "value"])
    assert exchanges(got) == 0
    want = dedupe_by_key(df, ["sensor_id", "latest_id"], ["at", "value"], keep_null_keys=False)
    assert exchanges(want) == 1
    same(got, want)
    with pytest.raises(ValueError):
        table.newest(["latest_id"], ["at"])


def test_join_moves_the_other_side(spark, stored):
    table, df = stored
    dims = spark.createDataFrame([(1, "a"), (2, "b"), (40, "c"), (7, "d")], "sensor_id long, name string")
    got = table.join(dims)
    assert exchanges(got) == 1
    same(got, df.join(dims, "sensor_id"))
    same(table.join(dims, "left"), df.join(dims, "sensor_id", "left"))


def test_upsert_moves_the_source(spark, stored):
    table, df = stored
    one = BucketedTable(spark, f"t_{uuid.uuid4().hex}", scratch_path(spark, "bucketed"), ["latest_id"], 4)
    target = dedupe_by_key(df.filter("latest_id < 'm4'"), "latest_id", ["at", "value"]).select(*df.columns)
    source = dedupe_by_key(df.filter("latest_id > 'm3'").withColumn("value", F.lit(None).cast("double")), "latest_id", ["at"]).select(*df.columns)
    target, source = (spark.createDataFrame(x.collect(), ROWS) for x in (target, source))
    one.write(target)
    got = one.merged(source)
    assert exchanges(got) == 1
    same(got, upsert(target, source, "latest_id"))
    one.drop()
