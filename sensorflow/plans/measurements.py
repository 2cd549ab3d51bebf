"""Measurement flow, pure part (I3): parse -> data rows -> typed columns ->
completeness -> composite key -> fixed column order -> per-key dedupe.

Works unchanged on a streaming frame up to ``measurement_rows``; the dedupe
(an aggregate) runs per micro-batch in the streaming runner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.casts import cast_timestamps
from sensorflow.functions.keys import composite_key
from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.operators.filters import control_rows, data_rows, drop_incomplete
from sensorflow.plans.common import MSG_ORDER, parse_object_messages
from sensorflow.schemas import MEASUREMENT_TABLE, MESSAGES, MessageSchemas

MEASUREMENT_COLUMNS = MEASUREMENT_TABLE.column_names


def parse_measurements(decoded: DataFrame, schemas: MessageSchemas = MESSAGES, keep_raw: bool = False) -> DataFrame:
    """B1 on the measurement topic: ``data`` struct + message order columns."""
    return parse_object_messages(decoded, schemas.measurement, "data", keep_raw)


def end_signals(parsed: DataFrame) -> DataFrame:
    """Control records (``{"end": true}``)."""
    return control_rows(parsed, "data.end")


REQUIRED = [c for c in MEASUREMENT_COLUMNS if c != "latest_id"]


def typed_measurements(parsed: DataFrame, local_mode: str = "wall_clock") -> DataFrame:
    """C1 -> casts -> composite key, every data message once: ``_reject`` tells
    why C3 refuses it (``unparsable`` when no field could be read, else
    ``incomplete:`` and the first column that is NULL or NaN) or is NULL."""
    utc, local = cast_timestamps("data.datetime.utc", "data.datetime.local", local_mode)
    rows = data_rows(parsed, "data.end").select(
        F.col("data.locationsId").alias("location_id"),
        F.col("data.sensorsId").alias("sensor_id"),
        F.col("data.value").alias("value"),
        utc.alias("timestamp_utc"),
        local.alias("timestamp_local"),
        F.col("data.coordinates.latitude").alias("latitude"),
        F.col("data.coordinates.longitude").alias("longitude"),
        *MSG_ORDER, *[c for c in ("_raw",) if c in parsed.columns])

    def missing(c: str):
        null = F.col(c).isNull()
        return (null | F.isnan(c)) if rows.schema[c].dataType.simpleString() in ("double", "float") else null

    unread = F.lit(True)
    for c in REQUIRED:
        unread = unread & F.col(c).isNull()
    reject = F.when(unread, F.lit("unparsable"))
    for c in REQUIRED:
        reject = reject.when(missing(c), F.lit(f"incomplete:{c}"))
    return rows.withColumns({"_reject": reject,
                             "latest_id": composite_key("sensor_id", "location_id", "timestamp_utc")})


def rejected_messages(typed: DataFrame) -> DataFrame:
    """``raw, reason`` and message order of every data message that gives no
    row; needs ``parse_measurements(..., keep_raw=True)``.  Rows of
    ``measurement_rows`` plus these are all data messages."""
    return typed.filter(F.col("_reject").isNotNull()).select(
        F.col("_raw").alias("raw"), F.col("_reject").alias("reason"), *MSG_ORDER)


def measurement_rows(parsed: DataFrame, local_mode: str = "wall_clock",
                     keep_order: bool = True) -> DataFrame:
    """C1 -> casts -> C3 -> composite key -> B10 column order."""
    rows = drop_incomplete(typed_measurements(parsed, local_mode).drop("_reject"), subset=REQUIRED)
    return rows.select(*MEASUREMENT_COLUMNS, *(MSG_ORDER if keep_order else []))


def latest_measurements(parsed: DataFrame, local_mode: str = "wall_clock") -> DataFrame:
    """Batch form of the whole flow: one row per ``latest_id`` (last writer wins)."""
    rows = measurement_rows(parsed, local_mode)
    return dedupe_by_key(rows, "latest_id", MSG_ORDER).select(*MEASUREMENT_COLUMNS)
