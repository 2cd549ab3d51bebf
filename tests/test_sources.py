"""Publishing, pages, envelopes and the JDBC statement text."""

import json

from pyspark.sql import functions as F

from sensorflow.functions.json import parse_struct
from sensorflow.operators.aggregates import offset_bounds
from sensorflow.operators.filters import skip_missing_id
from sensorflow.schemas import LOCATION, TABLES
from sensorflow.session import scratch_path
from sensorflow.sources.envelope import decode_value, file_topic_source, kafka_options
from sensorflow.sources.jdbc import upsert_sql
from sensorflow.sources.pages import first_result, flatten_pages, page_coverage
from sensorflow.sources.publish import (append_end_marker, is_topic_empty, publish_array,
                                        publish_if_empty, publish_rows)


def test_publish_rows_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    v = decode_value(publish_rows(df, "t", offset="id")).first().value
    assert json.loads(v) == {"id": 1, "name": None}


def test_publish_array_chunks_and_roundtrip(spark):
    df = spark.range(0, 250).selectExpr("id", "id % 2 as g")
    env = publish_array(df, "t", group=["g"], chunk=F.floor(F.col("id") / 100), offset="id")
    assert env.count() == 6  # 2 groups x 3 chunks
    back = decode_value(env).select(F.explode(F.from_json("value", "array<struct<id:bigint,g:bigint>>")).alias("e"))
    assert sorted(r.e.id for r in back.collect()) == list(range(250))


def test_end_marker_and_offset_bounds(spark, envelope):
    env = envelope([("a", 0, 0), ("b", 1, 0), ("c", 5, 1)])
    with_end = append_end_marker(env)
    ends = sorted((r.partition, r.offset) for r in with_end.filter("cast(value as string) like '%end%'").collect())
    assert ends == [(0, 2), (1, 6)]
    b = sorted((r.partition, r.low, r.high) for r in offset_bounds(env).collect())
    assert b == [(0, 0, 2), (1, 5, 6)]
    assert not is_topic_empty(env)
    assert is_topic_empty(env.limit(0))


def test_publish_if_empty(spark):
    path = scratch_path(spark, "test-topic")
    first = publish_rows(spark.createDataFrame([(1,)], "id int"), "t", offset="id")
    second = publish_rows(spark.createDataFrame([(2,), (3,)], "id int"), "t", offset="id")
    assert publish_if_empty(spark, first, path) is True
    assert publish_if_empty(spark, second, path) is False
    assert [r.value for r in decode_value(file_topic_source(spark, path)).collect()] == ['{"id":1}']


def test_e20_page_coverage(spark):
    page = lambda found, limit: json.dumps({"meta": {"found": found, "limit": limit}, "results": []})
    pages = spark.createDataFrame(
        [(1, 1, page(2000, 1000)), (1, 2, page(2000, 1000)), (2, 1, page(2000, 1000)), (3, 1, '{"results": []}')],
        "entity_id int, page int, body string")
    got = {r.entity_id: r.complete for r in page_coverage(pages).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_e21_e22_pages_results(spark):
    pages = spark.createDataFrame(
        [(1, 1, '{"results": []}'), (1, 2, '{"meta": {"found": 1}}'),
         (2, 1, '{"results": [{"id": 0}, {"id": null}, {"id": 5, "name": "x"}]}')],
        "entity_id int, page int, body string")
    flat = flatten_pages(pages, LOCATION)
    assert flat.count() == 3
    kept = skip_missing_id(flat.select("result.id", "result.name"), "id")
    assert [(r.id, r.name) for r in kept.collect()] == [(5, "x")]
    first = first_result(pages, LOCATION).select("entity_id", "result.id").collect()
    assert [(r.entity_id, r.id) for r in first] == [(2, 0)]


def test_kafka_options_and_sql_text():
    o = kafka_options("b:9092", "topic", **{"kafka.max.partition.fetch.bytes": 10485760})
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "topic", "startingOffsets": "earliest",
                 "kafka.max.partition.fetch.bytes": "10485760"}
    cols = TABLES["sensor"].column_names
    sql = upsert_sql("stage", "sensor", cols, "sensor_id")
    assert sql == ('INSERT INTO "sensor" ("sensor_id", "name", "parameter_id", "location_id") '
                   'SELECT "sensor_id", "name", "parameter_id", "location_id" FROM "stage" '
                   'ON CONFLICT ("sensor_id") DO UPDATE SET "name" = EXCLUDED."name", '
                   '"parameter_id" = EXCLUDED."parameter_id", "location_id" = EXCLUDED."location_id";')
    counted = upsert_sql("stage", "sensor", cols, "sensor_id", with_counts=True)
    assert "RETURNING (xmax = 0) AS is_insert" in counted and "FILTER (WHERE NOT is_insert)" in counted
    merge = upsert_sql("stage", "sensor", cols, "sensor_id", dialect="merge")
    assert merge.startswith('MERGE INTO "sensor" t USING "stage" s ON (t."sensor_id" = s."sensor_id")')


def test_target_tables_create_empty(spark):
    for spec in TABLES.values():
        df = spec.empty(spark)
        assert df.columns == spec.column_names and df.count() == 0


def test_single_object_parse(spark):
    df = spark.createDataFrame([('{"id": 4, "country": {"id": 22}}',)], "v string")
    r = df.select(parse_struct("v", LOCATION).alias("l")).first()
    assert (r.l.id, r.l.country.id) == (4, 22)


def test_bounded_chunks_split_a_hot_group(spark):
    from sensorflow.sources.publish import bounded_chunks
    df = spark.range(0, 20000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS g")
    out = bounded_chunks(df, ["g"], 100)
    sizes = [r["count"] for r in out.groupBy("g", "__chunk").count().collect()]
    assert sum(sizes) == 20000
    assert max(sizes) < 200  # the hot group (6,667 rows) is spread over 67 chunks
    assert out.filter("g = 0").select("__chunk").distinct().count() == 67
