"""Row filters and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def data_rows(df: DataFrame, marker: str = "data.end") -> DataFrame:
    """Ordinary records (no end marker)."""
    return df.filter(F.col(marker).isNull())


def control_rows(df: DataFrame, marker: str = "data.end") -> DataFrame:
    """Control records (``{"end": true}``)."""
    return df.filter(F.col(marker).isNotNull())


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any column (or ``subset``); NaN counts as missing."""
    return df.dropna(how="any", subset=subset)


def skip_missing_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """C4: skip records whose id is missing or falsy (NULL or 0)."""
    c = F.col(id_col)
    return df.filter(c.isNotNull() & (c != 0))


def select_country(df: DataFrame, country_col: str, country_id) -> DataFrame:
    """Keep one country."""
    return df.filter(F.col(country_col) == F.lit(country_id))


def nonempty(df: DataFrame) -> bool:
    """True when ``df`` has at least one row (one short job; persist first if reused)."""
    return not df.isEmpty()
