"""Shared pieces of the plans: parse a decoded envelope once, keep the
message order columns used as the last-writer-wins order of dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.json import parse_array, parse_struct

# (message timestamp, partition, offset) -- plus element position for arrays
MSG_ORDER = ["_msg_ts", "_partition", "_offset"]


def order_cols(decoded: DataFrame) -> list:
    return [F.col("timestamp").alias("_msg_ts"), F.col("partition").alias("_partition"),
            F.col("offset").alias("_offset")]


def parse_object_messages(decoded: DataFrame, schema: T.StructType, alias: str,
                          keep_raw: bool = False) -> DataFrame:
    """One row per message: ``alias`` struct + order columns (+ the message
    text as ``_raw``).

    The parsed struct goes through a one-element ``inline_outer`` so later
    filters on its fields cannot be pushed below the parse (which would parse
    each message twice); ``from_json`` runs once per message.
    """
    parsed = decoded.select(F.array(F.struct(parse_struct("value", schema).alias(alias),
                                             *order_cols(decoded),
                                             *([F.col("value").alias("_raw")] if keep_raw else []))).alias("__one"))
    return parsed.select(F.inline_outer("__one"))


def parse_array_messages(decoded: DataFrame, element: T.DataType, alias: str) -> DataFrame:
    """One row per message: ``alias`` array + order columns (explode next)."""
    return decoded.select(parse_array("value", element).alias(alias), *order_cols(decoded))
