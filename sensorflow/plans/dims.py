"""Dimension jobs.

I1: country messages (object with ``parameters[]``) + parameter messages
(arrays) -> ``country`` and ``parameter`` tables.  I2: location messages
(arrays of locations with ``sensors[]``) -> ``location_table`` and ``sensor``.

Semantics kept from the original jobs: inner explode (a country without
parameters and a location without sensors are not stored unless
``keep_empty``), parameters come only from countries, display name and
description always come from the parameter topic (NULL when absent there).
Changed on purpose: every dedupe is last-writer-wins and deterministic, the
parameter dimension is deduped before the join (no fan-out), local times keep
their wall clock, bad values become NULL instead of failing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.casts import cast_double, cast_timestamps
from sensorflow.functions.json import map_lookup
from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.operators.explode import explode_array
from sensorflow.operators.joins import enrich_left
from sensorflow.plans.common import MSG_ORDER, parse_array_messages, parse_object_messages
from sensorflow.schemas import (COUNTRY_TABLE, LOCATION_TABLE, MESSAGES, PARAMETER_TABLE, SENSOR_TABLE,
                                MessageSchemas)

ELEMENT_ORDER = MSG_ORDER + ["_pos"]


def parameter_dimension(parameter_decoded: DataFrame, schemas: MessageSchemas = MESSAGES) -> DataFrame:
    """Parameter topic -> one row per id: ``id, displayName, description``."""
    arr = parse_array_messages(parameter_decoded, schemas.parameter, "params")
    rows = explode_array(arr, "params", "p", pos_alias="_pos").select(
        F.col("p.id").alias("id"), F.col("p.displayName").alias("displayName"),
        F.col("p.description").alias("description"), *ELEMENT_ORDER)
    return dedupe_by_key(rows, "id", ELEMENT_ORDER, keep_null_keys=False).drop(*ELEMENT_ORDER)


Stage = Callable[[DataFrame], DataFrame]


def country_parameter_dims(country_decoded: DataFrame, parameter_decoded: DataFrame,
                           keep_empty: bool = False, dim_max_rows: int | None = None,
                           stage: Stage | None = None,
                           schemas: MessageSchemas = MESSAGES) -> tuple[DataFrame, DataFrame]:
    """I1 -> ``(country, parameter)`` frames shaped like their tables.

    Both outputs come from the same parsed messages; ``stage`` (e.g.
    ``sensorflow.session.materialize``) is applied to them so they are parsed
    once when both outputs are computed."""
    c = parse_object_messages(country_decoded, schemas.country, "c")
    if stage is not None:
        c = stage(c)
    countries = c.select(
        F.col("c.id").alias("id"), F.col("c.code").alias("code"), F.col("c.name").alias("name"),
        F.col("c.datetimeFirst").alias("datetimeFirst"), F.col("c.datetimeLast").alias("datetimeLast"),
        F.size("c.parameters").alias("_n"), *MSG_ORDER)
    if not keep_empty:
        # parity with the inner explode: no parameters -> no country row
        countries = countries.filter(F.col("_n") > 0)
    country = dedupe_by_key(countries.drop("_n"), "id", MSG_ORDER).select(*COUNTRY_TABLE.column_names)

    cp = explode_array(c.select(F.col("c.parameters").alias("params"), *MSG_ORDER),
                       "params", "p", pos_alias="_pos").select(
        F.col("p.id").alias("parameter_id"), F.col("p.name").alias("name"),
        F.col("p.units").alias("unit"), *ELEMENT_ORDER)
    cp = dedupe_by_key(cp, "parameter_id", ELEMENT_ORDER).drop(*ELEMENT_ORDER)
    dim = parameter_dimension(parameter_decoded, schemas)
    parameter = enrich_left(cp, dim, "parameter_id", "id",
                            {"display_name": "displayName", "description": "description"},
                            dim_max_rows=dim_max_rows).select(*PARAMETER_TABLE.column_names)
    return country, parameter


def location_rows(location_decoded: DataFrame, local_mode: str = "wall_clock",
                  schemas: MessageSchemas = MESSAGES) -> DataFrame:
    """Location messages -> one row per location element, typed, with its sensors array."""
    arr = parse_array_messages(location_decoded, schemas.location, "locs")
    locs = explode_array(arr, "locs", "l", pos_alias="_pos")
    f_utc, f_local = cast_timestamps("l.datetimeFirst.utc", "l.datetimeFirst.local", local_mode)
    l_utc, l_local = cast_timestamps("l.datetimeLast.utc", "l.datetimeLast.local", local_mode)
    return locs.select(
        F.col("l.id").alias("location_id"), F.col("l.name").alias("name"),
        F.col("l.locality").alias("locality"), F.col("l.country.id").alias("country_id"),
        cast_double(map_lookup("l.coordinates", "latitude")).alias("latitude"),
        cast_double(map_lookup("l.coordinates", "longitude")).alias("longitude"),
        F.col("l.timezone").alias("timezone"),
        f_utc.alias("datetime_first_utc"), f_local.alias("datetime_first_local"),
        l_utc.alias("datetime_last_utc"), l_local.alias("datetime_last_local"),
        F.col("l.sensors").alias("sensors"), *ELEMENT_ORDER)


def location_sensor_dims(location_decoded: DataFrame, keep_empty: bool = False,
                         local_mode: str = "wall_clock", stage: Stage | None = None,
                         schemas: MessageSchemas = MESSAGES) -> tuple[DataFrame, DataFrame]:
    """I2 -> ``(location_table, sensor)`` frames (B4 two-level explode + B8 split).

    ``stage`` is applied to the parsed location rows (see I1)."""
    rows = location_rows(location_decoded, local_mode, schemas)
    if stage is not None:
        rows = stage(rows)
    locs = rows if keep_empty else rows.filter(F.size("sensors") > 0)
    location = dedupe_by_key(locs.drop("sensors"), "location_id", ELEMENT_ORDER) \
        .select(*LOCATION_TABLE.column_names)
    sens = explode_array(rows.select("location_id", "sensors", *ELEMENT_ORDER), "sensors", "s",
                         pos_alias="_spos").select(
        F.col("s.id").alias("sensor_id"), F.col("s.name").alias("name"),
        F.col("s.parameter.id").alias("parameter_id"), "location_id", *ELEMENT_ORDER, "_spos")
    sensor = dedupe_by_key(sens, "sensor_id", ELEMENT_ORDER + ["_spos"]) \
        .select(*SENSOR_TABLE.column_names)
    return location, sensor
