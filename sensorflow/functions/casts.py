"""Tolerant typing.

Spark 4 runs with ANSI on, where ``cast`` throws on bad input.  Messages are
untrusted, so every data cast here is ``try_cast``: bad input becomes NULL and
the row is dealt with by the completeness filter or the constraint checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cast_double(col) -> Column:
    """String (or number) -> double; garbage -> NULL."""
    return _c(col).try_cast("double")


def cast_timestamps(utc, local, local_mode: str = "wall_clock") -> tuple[Column, Column]:
    """ISO-8601 strings -> (instant, local time).

    ``utc`` becomes a TIMESTAMP instant.  ``local`` keeps its wall clock as
    TIMESTAMP_NTZ (``...T01:00:00+01:00`` -> 01:00); ``local_mode="instant"``
    reproduces a plain timestamp cast, where the offset is applied and the
    local column equals the UTC instant.
    """
    if local_mode not in ("wall_clock", "instant"):
        raise ValueError(f"local_mode must be 'wall_clock' or 'instant', not {local_mode!r}")
    utc_col = _c(utc).try_cast("timestamp")
    local_type = "timestamp_ntz" if local_mode == "wall_clock" else "timestamp"
    return utc_col, _c(local).try_cast(local_type)


def instant_to_utc_ntz(col) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ holding its UTC wall clock.

    Independent of the session time zone (goes through epoch microseconds).
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(_EPOCH_NTZ_SQL))


def iso_utc(col) -> Column:
    """Render a TIMESTAMP_NTZ wall clock (taken as UTC) as ``yyyy-MM-ddTHH:mm:ss.ffffffZ``."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_with_offset(col, offset: str = "+01:00") -> Column:
    """Render a TIMESTAMP_NTZ wall clock with a fixed UTC offset suffix."""
    return F.concat(F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(offset))


def conform_casts(df: DataFrame, casts: dict | None) -> DataFrame:
    """Apply ``{column: type}`` casts to the columns that exist; others are ignored."""
    if not casts:
        return df
    present = {c: _c(c).try_cast(t) for c, t in casts.items() if c in df.columns}
    return df.withColumns(present) if present else df
