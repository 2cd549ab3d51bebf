"""Ingestion, data part (I4): landed API pages -> the four topics.

The collector's HTTP client, rate limiting and retries are not part of this
library; its landed responses are.  For one country:

* ``country``: the country object (A14), one message;
* ``parameter``: the parameters the country refers to (E5, D3) as arrays (A9);
* ``locations``: every landed location of the country as arrays, ids or not;
* ``measurements``: the results landed for locations that have an id (C4), one
  message each (A8), closed by end records after the data (A11).

Nothing is built from an incomplete landing: ``ingest_topics`` first looks for
missing pages (A13) and raises ``IncompleteLanding``, which names them.  Offsets are
ranks within the topic partition, whatever the ids and page sizes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.aggregates import collect_ids
from sensorflow.operators.filters import select_country, skip_missing_id
from sensorflow.operators.joins import referenced_dim_rows
from sensorflow.sources.envelope import to_envelope
from sensorflow.sources.pages import first_result, flatten_pages, missing_pages, page_coverage
from sensorflow.sources.publish import bounded_chunks, publish_then_end, publish_to_empty_topic

JSON = {"ignoreNullFields": "false"}


def landed_to_messages(pages: DataFrame, result_type: T.StructType, country_id=None,
                       topic: str = "locations", country_path: str = "country.id",
                       landed_at=None) -> DataFrame:
    """Results with an id, of one country if given, one message each."""
    flat = flatten_pages(pages, result_type).select("entity_id", "page", "result_pos", "result")
    flat = skip_missing_id(flat.withColumn("__id", F.col("result.id")), "__id")
    if country_id is not None:
        flat = select_country(flat.withColumn("__country", F.col(f"result.{country_path}")),
                              "__country", country_id)
    return to_envelope(flat, F.to_json(F.col("result"), JSON), topic, key=F.col("__id"), offset=F.col("__id"),
                       timestamp=landed_at)


def incomplete(pages: DataFrame) -> DataFrame:
    """Entities whose pages are not all there."""
    return page_coverage(pages).filter(~F.col("complete"))


class IncompleteLanding(ValueError):
    """Pages are missing; ``ranges`` lists the first of them."""

    def __init__(self, ranges: list[tuple]):
        super().__init__("missing pages (what, entity, first, last): " + ", ".join(map(str, ranges)))
        self.ranges = ranges


def refuse_incomplete(landed: dict[str, DataFrame], shown: int = 20) -> None:
    """Raises ``IncompleteLanding`` if pages of any of ``landed`` are missing."""
    gaps = [missing_pages(pages).select(F.lit(name).alias("what"), F.col("entity_id").cast("string").alias("entity"),
                                        "first_missing", "last_missing") for name, pages in landed.items()]
    first = reduce(DataFrame.unionByName, gaps).orderBy("what", "entity", "first_missing").limit(shown).collect()
    if first:
        raise IncompleteLanding([tuple(r) for r in first])


def with_ranks(rows: DataFrame, partition: Column, entity: str, page: str, position: str | None = None) -> DataFrame:
    """``rows`` with ``__part`` and ``__offset``: 0, 1, ... within a partition by
    entity, page and position (from 0).

    Rows are counted per page; pages are summed up within their entity and
    entities within their partition, so windows hold one row a page of one
    entity, or one row an entity, and never the rows."""
    rows = rows.withColumn("__part", partition)
    last = F.max(position) if position else F.lit(0)
    pages = rows.groupBy("__part", entity, page).agg((last + 1).cast("bigint").alias("__n"))
    entities = pages.groupBy("__part", entity).agg(F.sum("__n").alias("__n"))

    def before(by: list[str], order: str) -> Column:
        frame = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__n").over(frame), F.lit(0))

    pages = pages.withColumn("__p", before(["__part", entity], page)).drop("__n")
    entities = entities.withColumn("__e", before(["__part"], entity)).drop("__n")
    starts = pages.join(entities, ["__part", entity]).withColumn("__start", F.col("__p") + F.col("__e")).drop("__p", "__e")
    at = F.col(position) if position else F.lit(0)
    return rows.join(starts, ["__part", entity, page]).withColumn("__offset", F.col("__start") + at).drop("__start")


def _arrays(results: DataFrame, topic: str, max_rows: int, landed_at) -> DataFrame:
    """Results as array messages of about ``max_rows`` elements."""
    # maps cannot be grouped by, so results travel as JSON; arrays keep the order of landing
    rows = results.select("entity_id", "page", "result_pos", F.to_json("result", JSON).alias("json"))
    chunks = bounded_chunks(rows, ["entity_id"], max_rows, alias="chunk")
    grouped = chunks.groupBy("entity_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("page", "result_pos", "json"))).alias("items"))
    value = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["json"]), ","), F.lit("]"))
    messages = grouped.select("entity_id", "chunk", value.alias("json"))
    return to_envelope(with_ranks(messages, F.lit(0), "entity_id", "chunk"), F.col("json"), topic, offset=F.col("__offset"),
                       timestamp=landed_at)


def ingest_topics(country_id, countries: DataFrame, country_type: T.StructType,
                  parameter_pages: DataFrame, parameter_type: T.StructType,
                  location_pages: DataFrame, location_type: T.StructType,
                  measurement_pages: DataFrame, measurement_type: T.StructType,
                  partitions: int = 3, max_rows: int = 1000, landed_at=None,
                  stage: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Envelopes of the four topics for one country; ``measurements`` without
    its end records, which ``publish_topics`` writes after the data.

    ``stage`` is applied to what several outputs need: the country's locations
    and the rendered measurements (``materialize`` parses each page once)."""
    stage = stage or (lambda df: df)
    refuse_incomplete({"parameter": parameter_pages, "locations": location_pages, "measurements": measurement_pages})
    country = first_result(countries.filter(F.col("entity_id") == F.lit(country_id)), country_type)
    messages = {"country": to_envelope(country, F.to_json("result", JSON), "country",
                                       offset=F.lit(0), timestamp=landed_at)}

    used = collect_ids(country.select(F.col("result.parameters").alias("p")), "p", alias="id")
    parameters = flatten_pages(parameter_pages, parameter_type).withColumn("id", F.col("result.id"))
    messages["parameter"] = _arrays(referenced_dim_rows(parameters, used, "id", "id"), "parameter", max_rows,
                                    landed_at)

    locations = flatten_pages(location_pages, location_type)
    locations = stage(select_country(locations.withColumn("__c", F.col("result.country.id")), "__c", country_id))
    messages["locations"] = _arrays(locations, "locations", max_rows, landed_at)

    ids = skip_missing_id(locations.select(F.col("result.id").alias("entity_id")), "entity_id").distinct()
    # pages of other locations are dropped before they are parsed
    wanted = measurement_pages.join(ids, "entity_id", "left_semi")
    measured = stage(flatten_pages(wanted, measurement_type).select(
        "entity_id", "page", "result_pos", F.to_json("result", JSON).alias("json")))
    numbered = with_ranks(measured, F.pmod("entity_id", F.lit(partitions)), "entity_id", "page", "result_pos")
    messages["measurements"] = to_envelope(numbered, F.col("json"), "measurements", key=F.col("entity_id"),
                                           partition=F.col("__part"), offset=F.col("__offset"), timestamp=landed_at)
    return messages


def publish_topics(messages: dict[str, DataFrame], read: Callable[[str], DataFrame],
                   write: Callable[[str, DataFrame], None]) -> dict[str, bool]:
    """Publish the dimension topics that hold no record yet (A10) and then the
    measurements with their end records; whether each was published."""
    done = {}
    for topic in ("country", "parameter", "locations"):
        done[topic] = publish_to_empty_topic(messages[topic], lambda t=topic: read(t),
                                             lambda m, t=topic: write(t, m))
    publish_then_end(messages["measurements"], lambda m: write("measurements", m))
    done["measurements"] = True
    return done
