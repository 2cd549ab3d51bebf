"""JSON columns: parse by a fixed schema, render back, map lookups.

All parsing is ``from_json`` in PERMISSIVE mode (no options): a malformed
object root gives a struct of NULLs, a malformed array root gives NULL, a bad
field only nulls that field.  Everything stays JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_struct(col, schema: T.StructType | str) -> Column:
    """B1: JSON object -> struct (string or binary input); ``schema`` may be DDL text."""
    return F.from_json(_c(col).cast("string"), schema)


def parse_array(col, element: T.DataType | str) -> Column:
    """B2: JSON array -> array<element>.  A lone object parses as a 1-element array.
    ``element`` is a type or a struct DDL string (``"a int, b string"``)."""
    if isinstance(element, str):
        element = T.StructType.fromDDL(element)
    schema = element if isinstance(element, T.ArrayType) else T.ArrayType(element)
    return F.from_json(_c(col).cast("string"), schema)


def map_lookup(map_col, key: str) -> Column:
    """Value of ``key`` in a map; a missing key or NULL map gives NULL."""
    return F.try_element_at(_c(map_col), F.lit(key))
