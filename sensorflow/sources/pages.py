"""Landed API pages.

A landed page is a row ``(entity_id, page, body)``: the page number is a
request parameter, the body the JSON response ``{meta: {found, limit},
results: [...]}``.  The HTTP fetching itself is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.json import parse_struct
from sensorflow.operators.explode import explode_array
from sensorflow.operators.gaps import missing_ranges
from sensorflow.schemas import page_schema

DEFAULT_LIMIT = 1000


def flatten_pages(pages: DataFrame, result_type: T.DataType, body: str = "body",
                  keep: tuple[str, ...] = ("entity_id", "page")) -> DataFrame:
    """One row per result (``result``) over all pages; a page without
    ``results`` or with an empty list contributes nothing."""
    parsed = pages.select(*keep, parse_struct(body, page_schema(result_type)).alias("__page"))
    return explode_array(parsed.select(*keep, F.col("__page.results").alias("__results")),
                         "__results", "result", pos_alias="result_pos")


def page_coverage(pages: DataFrame, entity: str = "entity_id", page: str = "page",
                  body: str = "body", default_limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Per entity, whether the landed pages reach the collector's stop
    rule ``found <= limit * page`` (missing meta: found 0, limit 1000) and no
    page from 1 to the last is missing.  Pages count from 1."""
    meta = T.StructType([T.StructField("meta", T.StructType([
        T.StructField("found", T.LongType()), T.StructField("limit", T.LongType())]))])
    parsed = pages.select(entity, page, parse_struct(body, meta).alias("__p"))
    per = parsed.groupBy(entity).agg(
        F.count_distinct(page).alias("pages"), F.max(page).alias("max_page"),
        F.max("__p.meta.found").alias("found"), F.max("__p.meta.limit").alias("page_limit"))
    return per.withColumn(
        "complete", (F.col("pages") == F.col("max_page")) &
        (F.coalesce(F.col("found"), F.lit(0)) <= F.coalesce(F.col("page_limit"), F.lit(default_limit)) * F.col("max_page")))


def missing_pages(pages: DataFrame, entity: str = "entity_id", page: str = "page", body: str = "body",
                  default_limit: int = DEFAULT_LIMIT) -> DataFrame:
    """``entity, first_missing, last_missing``: pages that a landing lacks, from
    the first to the one that the stop rule names (A13)."""
    cover = page_coverage(pages, entity, page, body, default_limit)
    found, limit = F.coalesce("found", F.lit(0)), F.greatest(F.coalesce("page_limit", F.lit(default_limit)), F.lit(1))
    last = F.call_function("div", found + limit - 1, limit)
    bounds = cover.select(entity, F.lit(1).alias("low"), F.greatest(last, F.col("max_page").cast("bigint"), F.lit(1)).alias("high"))
    return missing_ranges(pages, [entity], page, bounds)


def first_result(responses: DataFrame, result_type: T.DataType, body: str = "body",
                 keep: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    """First element of ``results`` of single-entity responses; failed
    responses (no ``results``) and empty lists are skipped."""
    parsed = responses.select(*keep, parse_struct(body, page_schema(result_type)).alias("__p"))
    return (parsed.select(*keep, F.get(F.col("__p.results"), 0).alias("result"))
            .filter(F.col("result").isNotNull()))
