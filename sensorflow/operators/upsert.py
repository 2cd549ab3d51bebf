"""Keyed upsert as DataFrame algebra.

``INSERT ... ON CONFLICT (key) DO UPDATE SET every other column`` replaces
the whole row, NULLs included, so the merge is ``target ANTI source ∪
source`` -- never ``coalesce(src, tgt)``.  The source must be unique on the
key (run ``dedupe_by_key`` first; two rows with one key are an error in the
database form).

Scale: the target is only streamed.  When the caller knows the source is
small (``source_rows``, e.g. the counted micro-batch) its keys are broadcast
and the target is not shuffled at all; otherwise both sides shuffle on the key
and AQE may still pick a broadcast from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.aggregates import filtered_counts
from sensorflow.operators.joins import fits_broadcast


def _source_keys(source: DataFrame, key: list[str], source_rows: int | None) -> DataFrame:
    keys = source.select(*key)
    if fits_broadcast(source, key, source_rows):
        keys = F.broadcast(keys)
    return keys


def upsert(target: DataFrame, source: DataFrame, key: list[str] | str,
           source_rows: int | None = None) -> DataFrame:
    """A5: rows of ``target`` after upserting ``source`` (whole-row replace)."""
    key = [key] if isinstance(key, str) else list(key)
    cols = target.columns
    kept = target.join(_source_keys(source, key, source_rows), key, "left_anti")
    return kept.unionByName(source.select(*cols))


def upsert_counts(target: DataFrame, source: DataFrame, key: list[str] | str,
                  source_rows: int | None = None) -> DataFrame:
    """One row ``(inserts, updates)`` the upsert of ``source`` would report.

    Only target keys that also occur in the source travel (semi join); the
    final count shuffles O(source) rows, never the target.
    """
    key = [key] if isinstance(key, str) else list(key)
    matched = target.select(*key).join(_source_keys(source, key, source_rows), key, "left_semi")
    tagged = (source.select(*key).withColumn("__m", F.lit(0))
              .unionByName(matched.withColumn("__m", F.lit(1))))
    per_key = tagged.groupBy(*key).agg(F.max("__m").alias("__m"))
    return filtered_counts(per_key, inserts=F.col("__m") == 0, updates=F.col("__m") == 1)
