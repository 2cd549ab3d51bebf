"""Ingestion refuses incomplete landings, numbers rows by rank, computes data once."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sensorflow.plans.ingest import IncompleteLanding, ingest_topics, publish_topics, with_ranks
from sensorflow.schemas import ENVELOPE
from sensorflow.schemas import WIDE_MESSAGES as W
from sensorflow.session import materialize
from sensorflow.sources.publish import publish_then_end

BIG = 10**10
PAGES = "entity_id long, page int, body string"


def page(results, found=None, limit=None):
    meta = {"meta": {"found": found, "limit": limit}} if found is not None else {}
    return json.dumps({**meta, "results": results})


def measurement(location, sensor, minute):
    return {"datetime": {"utc": f"2024-01-01T00:{minute % 60:02d}:00Z", "local": None}, "value": 1.0, "sensorsId": sensor, "locationsId": location}


def landed(spark, location_pages, measurement_pages):
    def frame(rows):
        return spark.createDataFrame(rows, PAGES)

    return ingest_topics(
        1, spark.createDataFrame([(1, page([{"id": 1, "code": "A", "name": "a", "parameters": [{"id": 5}]}]))], "entity_id long, body string"),
        W.country, frame([(0, 1, page([{"id": 5, "name": "p", "units": "u"}, {"id": 6, "name": "q", "units": "u"}]))]), W.parameter,
        frame(location_pages), W.location, frame(measurement_pages), W.measurement, stage=materialize)


def test_large_pages_and_ids_get_offsets_of_their_own(spark):
    locations = [{"id": i, "name": "l", "country": {"id": 1}} for i in (BIG, BIG + 3, 7)] + [{"id": None, "name": "x", "country": {"id": 1}}]
    pages = [(BIG, p, page([measurement(BIG, 1, i) for i in range(n)])) for p, n in ((1, 1000), (2, 5000), (3, 1))]
    pages += [(BIG + 3, 1, page([measurement(BIG + 3, 2, 0)])), (7, 1, page([measurement(7, 3, 0)])), (8, 1, page([measurement(8, 3, 0)]))]
    topics = landed(spark, [(1, 1, page(locations))], pages)
    rows = topics["measurements"].select("partition", "offset", F.col("key").cast("string").alias("k")).collect()
    assert len(rows) == 6003 and len({(r["partition"], r["offset"]) for r in rows}) == 6003
    for p in {r["partition"] for r in rows}:
        mine = sorted(r["offset"] for r in rows if r["partition"] == p)
        assert mine == list(range(len(mine)))
    assert topics["locations"].count() == 1 and topics["parameter"].first()["value"].decode().count('"id"') == 1


def test_an_incomplete_landing_is_refused_by_name(spark):
    locations = [(1, p, page([{"id": 7, "name": "l", "country": {"id": 1}}], 250, 100)) for p in (1, 3)]
    with pytest.raises(IncompleteLanding) as e:
        landed(spark, locations, [(7, 2, page([measurement(7, 3, 0)]))])
    assert e.value.ranges == [("locations", "1", 2, 2), ("measurements", "7", 1, 1)]


def test_ranks_by_entity_page_and_position(spark):
    rows = [(e, p, i) for e in (5, 2, BIG) for p in range(1, 4) for i in range(e % 3 + p)]
    df = spark.createDataFrame(rows, "e long, p int, i int").repartition(5)
    got = sorted((r["__part"], r["__offset"], r["e"], r["p"], r["i"]) for r in with_ranks(df, F.col("e") % 2, "e", "p", "i").collect())
    want = []
    for part in (0, 1):
        mine = sorted(r for r in rows if r[0] % 2 == part)
        want += [(part, k, *r) for k, r in enumerate(mine)]
    assert got == want


def test_the_data_is_computed_once_and_markers_fit_it(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([(None, b"x", "t", p, o, dt.datetime(2024, 1, 1), 0) for p in (0, 2) for o in range(p, 4)], ENVELOPE)
    writes = []
    publish_then_end(rows.withColumn("offset", counted("offset")), lambda df: writes.append(df.collect()))
    assert seen.value == rows.count() == 6
    assert sorted((r["partition"], r["offset"], bytes(r["value"])) for r in writes[1]) == [(0, 4, b'{"end":true}'), (2, 4, b'{"end":true}')]
    # more partitions than are observed
    publish_then_end(rows, lambda df: writes.append(df.collect()), partitions=2)
    assert sorted((r["partition"], r["offset"]) for r in writes[3]) == [(0, 4), (2, 4)]
    publish_then_end(rows.limit(0), lambda df: writes.append(df.collect()))
    assert len(writes) == 5 and writes[4] == []


def test_publishing_to_topics_that_hold_records(spark):
    empty = spark.createDataFrame([], ENVELOPE)
    row = spark.createDataFrame([(None, b"x", "t", 0, 0, dt.datetime(2024, 1, 1), 0)], ENVELOPE)
    written = []
    done = publish_topics({t: row for t in ("country", "parameter", "locations", "measurements")},
                          lambda t: row if t == "country" else empty, lambda t, m: written.append((t, m.count())))
    assert done == {"country": False, "parameter": True, "locations": True, "measurements": True}
    assert written == [("parameter", 1), ("locations", 1), ("measurements", 1), ("measurements", 1)]
