"""Deterministic per-key dedupe.

``dropDuplicates`` keeps an arbitrary row (it changes with partitioning).  Here
the last writer wins: per key the row with the greatest ``order`` struct is
kept, e.g. ``(timestamp, partition, offset, pos)`` of the message it came from;
the order must be total for a deterministic result.

Scale: a ``groupBy`` + ``max_by`` aggregate is computed partially on the map
side, so a key holding a third of all rows is reduced to one row per map task
before the shuffle (a window would put that whole key in one task).  Rows with
a NULL key are passed through untouched so the primary-key check can
quarantine every one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, key: list[str] | str, order: list[str],
                  keep_null_keys: bool = True) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    order_struct = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in others])
    src = df if keep_null_keys else df.filter(~null_key)
    # One aggregation, no second pass over the input: a row with a NULL key
    # is grouped by its own order value as well, so it stays on its own.
    lone = F.when(null_key, order_struct).alias("__lone") if keep_null_keys else None
    group = [F.col(k) for k in keys] + ([lone] if lone is not None else [])
    return (src.groupBy(*group)
            .agg(F.max_by(payload, order_struct).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])
            .select(*df.columns))
