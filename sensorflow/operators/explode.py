"""Array flattening (B3; B4 is two of these, see ``plans.dims``).

``explode`` semantics by default: NULL or empty arrays contribute no row
(countries without parameters, locations without sensors vanish).
``keep_empty=True`` keeps them with a NULL element (``explode_outer``).

Implementation note: the inner form is ``posexplode_outer`` + ``pos IS NOT
NULL``.  A plain ``explode`` makes Catalyst infer ``size(arr) > 0`` below the
generator, which re-evaluates ``from_json`` a second time; the outer form does
not, so each message is parsed once.  The element position is kept: it is the
last tie-breaker for deterministic dedupe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_array(df: DataFrame, array_col, alias: str, pos_alias: str | None = None,
                  keep_empty: bool = False, drop_source: bool = True) -> DataFrame:
    """One row per element of ``array_col`` as column ``alias`` (+ position)."""
    pos = pos_alias or f"{alias}_pos"
    col = F.col(array_col) if isinstance(array_col, str) else array_col
    keep = [c for c in df.columns if not (drop_source and isinstance(array_col, str) and c == array_col)]
    out = df.select(*keep, F.posexplode_outer(col).alias(pos, alias))
    if not keep_empty:
        out = out.filter(F.col(pos).isNotNull())
    return out
