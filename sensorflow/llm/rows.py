"""Row numbers that stay with their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.session import materialize


def number(df: DataFrame, out_col: str, codec: str | None = None) -> DataFrame:
    """``df`` with a row number, written once.  A scan planned anew may cut its
    files otherwise, when executors came or went, and would number rows anew;
    later steps read the number that was stored."""
    return materialize(df.withColumn(out_col, F.monotonically_increasing_id()), "numbered", codec)
