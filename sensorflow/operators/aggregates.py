"""Counts and bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filtered_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """``COUNT(*) FILTER (WHERE cond)`` per named condition, one row."""
    return df.agg(*[F.count_if(cond).cast("bigint").alias(name) for name, cond in conditions.items()])


def offset_bounds(envelope: DataFrame) -> DataFrame:
    """Per topic partition the low (first) and high (next) offsets."""
    return (envelope.groupBy("topic", "partition")
            .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")))


def collect_ids(df: DataFrame, array_col: str, id_field: str = "id", alias: str = "id") -> DataFrame:
    """E5: distinct ids found in an array-of-struct column (one row per id)."""
    return (df.select(F.explode(F.col(array_col)).alias("__e"))
            .select(F.col(f"__e.{id_field}").alias(alias))
            .filter(F.col(alias).isNotNull())
            .distinct())
