"""Composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.functions.casts import instant_to_utc_ntz


def composite_key(sensor, location, timestamp_utc, sep: str = "_") -> Column:
    """``sensor_location_timestamp`` key of a measurement.

    The timestamp is rendered as its UTC wall clock (``yyyy-MM-dd HH:mm:ss[.f]``,
    trailing fraction zeros dropped), so the key does not depend on the session
    time zone.  ``concat_ws`` skips NULL parts.
    """
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    return F.concat_ws(sep, c(sensor), c(location),
                       instant_to_utc_ntz(c(timestamp_utc)).cast("string"))
